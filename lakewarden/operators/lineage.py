"""Lineage edges, nodes and downstream impact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.session import checkpoint

#: Rounds breadth first before an impact search condenses the graph.
LEVELS = 8


def lineage_edges(models: DataFrame, dependencies: DataFrame) -> DataFrame:
    """Distinct `(parent, child)` table ids; parents that are no model are ignored."""
    parents = models.select(
        F.lower("unique_id").alias("__u"), F.col("table_id").alias("parent")
    )
    joined = dependencies.join(parents, F.lower("parent_unique_id") == F.col("__u"))
    return joined.select("parent", F.col("table_id").alias("child")).distinct()


def lineage_nodes(models: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes with their number of direct children; the edges stay a table of their own."""
    children = edges.groupBy(F.col("parent").alias("table_id")).agg(
        F.count(F.lit(1)).alias("downstream")
    )
    return models.join(children, "table_id", "left").select(
        "table_id",
        "name",
        F.lit("Table").alias("type"),
        F.coalesce("downstream", F.lit(0).cast("bigint")).alias("downstream"),
        F.try_element_at("meta", F.lit("owner")).alias("owner_team"),
        F.try_element_at("meta", F.lit("owner_email")).alias("owner_email"),
    )


def child_lists(edges: DataFrame, per_row: int = 1000) -> DataFrame:
    """Direct children as sorted lists `(parent, part, children)`.

    A parent with many children is spread over parts of about `per_row`, chosen by the child's
    name, so no list grows with the graph. The children are counted per parent first, and only
    that count travels back to the edges.
    """
    counts = edges.groupBy("parent").agg(F.count(F.lit(1)).alias("__n"))
    parts = F.ceil(F.col("__n") / F.lit(per_row)).cast("bigint")
    part = F.pmod(F.xxhash64("child"), parts).alias("part")
    spread = edges.join(counts, "parent").select("parent", part, "child")
    return spread.groupBy("parent", "part").agg(
        F.sort_array(F.collect_set("child")).alias("children")
    )


def downstream_impact(edges: DataFrame, roots: DataFrame, max_depth: int | None = None) -> DataFrame:
    """`(root, node, depth)` for everything reachable from the `roots` (column `root`).

    A few rounds breadth first reach the end of most graphs. Where they do not, the graph is
    condensed: a run of nodes with one parent and one child each becomes one edge with a length,
    found in rounds that double (`_runs`), and the search goes on over what is left. Every round
    is checkpointed, so the plan stays short and a lost executor replays one round. Cycles end by
    themselves. `max_depth` is a guard that raises, it never cuts a result.
    """
    graph = checkpoint(edges.select("parent", "child").where("parent <> child").distinct())
    seen = checkpoint(roots.select("root", F.col("root").alias("node"), F.lit(0).alias("depth")).distinct())
    frontier = seen
    for depth in range(1, LEVELS + 1):
        reached = frontier.join(graph, frontier["node"] == graph["parent"]).select(
            "root", F.col("child").alias("node")
        )
        fresh = reached.distinct().join(seen, ["root", "node"], "left_anti")
        frontier = checkpoint(fresh.withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        _guard(depth, max_depth)
        seen = seen.unionByName(frontier)
    else:
        seen = _condensed_impact(graph, roots.select("root").distinct(), max_depth)
    return seen.where(F.col("depth") > 0)


def _guard(depth: int, max_depth: int | None) -> None:
    if max_depth is not None and depth > max_depth:
        raise RuntimeError(f"lineage is deeper than {max_depth}")


def _runs(inner: DataFrame, links: DataFrame) -> DataFrame:
    """`(node, end, steps)`: where a walk along `links(node, end)` leaves the `inner` nodes, and after how many steps.

    Each round joins the walks with themselves, which doubles them. Walks that never leave, which
    are cycles of inner nodes alone, are dropped.
    """
    inside = inner.select(F.col("node").alias("__in"))
    walks = checkpoint(links.join(inner, "node").withColumn("steps", F.lit(1).cast("bigint")))
    for _ in range(walks.count().bit_length() + 1):
        further = walks.select(
            F.col("node").alias("end"), F.col("end").alias("__end"), F.col("steps").alias("__steps")
        )
        longer = walks.join(further, "end", "left").select(
            "node",
            F.coalesce("__end", "end").alias("end"),
            (F.col("steps") + F.coalesce("__steps", F.lit(0))).alias("steps"),
        )
        walks = checkpoint(longer)
        if walks.join(inside, F.col("end") == F.col("__in"), "left_semi").isEmpty():
            return walks
    return walks.join(inside, F.col("end") == F.col("__in"), "left_anti")


def _condensed_impact(graph: DataFrame, roots: DataFrame, max_depth: int | None) -> DataFrame:
    """Least depths by way of the graph without inner nodes, whose edges have lengths."""
    one = graph.groupBy(F.col("child").alias("node")).agg(F.count(F.lit(1)).alias("n"), F.min("parent").alias("before"))
    two = graph.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("m"), F.min("child").alias("after"))
    inner = checkpoint(
        one.where("n = 1").join(two.where("m = 1"), "node")
        .join(roots.withColumnRenamed("root", "node"), "node", "left_anti")
        .select("node", "before", "after")
    )
    nodes = inner.select("node")
    exits = _runs(nodes, inner.select("node", F.col("after").alias("end")))
    entries = _runs(nodes, inner.select("node", F.col("before").alias("end")))
    outer = graph.join(nodes, F.col("parent") == F.col("node"), "left_anti")
    lengths = outer.join(exits, F.col("child") == F.col("node"), "left").join(
        nodes.select(F.col("node").alias("__inner")), F.col("child") == F.col("__inner"), "left"
    )
    # an edge into a run ends where the run does; one into a cycle of inner nodes cannot be
    short = checkpoint(
        lengths.where("end is not null or __inner is null")
        .groupBy("parent", F.coalesce("end", "child").alias("to"))
        .agg(F.min(F.lit(1) + F.coalesce("steps", F.lit(0))).alias("length"))
    )
    known = checkpoint(roots.select("root", F.col("root").alias("node"), F.lit(0).cast("bigint").alias("depth")))
    frontier = known
    while True:
        reached = frontier.join(short, F.col("node") == F.col("parent")).groupBy(
            "root", F.col("to").alias("node")
        ).agg(F.min(F.col("depth") + F.col("length")).alias("depth"))
        old = known.select("root", "node", F.col("depth").alias("__old"))
        frontier = checkpoint(
            reached.join(old, ["root", "node"], "left").where("__old is null or depth < __old").drop("__old")
        )
        deepest = frontier.agg(F.min("depth")).first()[0]
        if deepest is None:
            break
        _guard(deepest, max_depth)
        known = checkpoint(known.unionByName(frontier).groupBy("root", "node").agg(F.min("depth").alias("depth")))
    along = entries.select(F.col("node").alias("__node"), F.col("end").alias("node"), "steps")
    within = known.join(along, "node").select(
        "root", F.col("__node").alias("node"), (F.col("depth") + F.col("steps")).alias("depth")
    )
    found = known.unionByName(within).select("root", "node", F.col("depth").cast("int").alias("depth"))
    if max_depth is not None:
        _guard(found.agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0], max_depth)
    return found
