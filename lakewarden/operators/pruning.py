"""File pruning on a file inventory, fail-closed for mandatory columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.operators.predicates import Predicate, compare, typed
from lakewarden.session import broadcast_if_bounded


def _bounds_may_match(low: Column, high: Column, op: str, value: Column) -> Column:
    return {
        "==": lambda: (low <= value) & (value <= high),
        "!=": lambda: ~((low == value) & (high == value)),
        ">": lambda: high > value,
        ">=": lambda: high >= value,
        "<": lambda: low < value,
        "<=": lambda: low <= value,
    }[op]()


def _may_match(p: Predicate, data_type: T.DataType) -> Column:
    """False only when partition value or bounds prove that no row can match."""
    name = F.lit(p.column.lower())
    value = typed(p.value, data_type)
    has_partition = F.map_contains_key("partition", name)
    part = F.try_element_at("partition", name).try_cast(data_type)
    part_unreadable = part.isNull() & F.try_element_at("partition", name).isNotNull()
    part_ok = part_unreadable | F.coalesce(compare(part, p.op, value), F.lit(False))
    low = F.try_element_at("lower_bounds", name).try_cast(data_type)
    high = F.try_element_at("upper_bounds", name).try_cast(data_type)
    bounds_ok = (
        low.isNull()
        | high.isNull()
        | F.coalesce(_bounds_may_match(low, high, p.op, value), F.lit(False))
    )
    return (~has_partition | part_ok) & bounds_ok


def _has_evidence(column: str, data_type: T.DataType) -> Column:
    """A readable partition value, or both readable bounds."""
    name = F.lit(column.lower())
    part = F.try_element_at("partition", name).try_cast(data_type)
    low = F.try_element_at("lower_bounds", name).try_cast(data_type)
    high = F.try_element_at("upper_bounds", name).try_cast(data_type)
    return part.isNotNull() | (low.isNotNull() & high.isNotNull())


def mark_files(
    inventory: DataFrame,
    predicates: Iterable[Predicate],
    types: Mapping[str, T.DataType],
    mandatory: Iterable[str] = (),
) -> DataFrame:
    """Adds `keep` to the file inventory: a filter over file rows, no shuffle.

    Files without evidence for a mandatory column are dropped, and so is every file when a
    mandatory column has no predicate.
    """
    predicates = list(predicates)
    types = {k.lower(): v for k, v in types.items()}
    filtered = {p.column.lower() for p in predicates}
    checks = [_may_match(p, types[p.column.lower()]) for p in predicates]
    for column in mandatory:
        if column.lower() not in filtered:
            checks.append(F.lit(False))
        else:
            checks.append(_has_evidence(column, types[column.lower()]))
    keep = reduce(lambda a, b: a & b, checks, F.lit(True))
    return inventory.withColumn("keep", keep)


def scan_statistics(marked: DataFrame) -> DataFrame:
    """One row: files scanned, files pruned, share pruned in percent, rows and bytes kept."""
    total = F.count(F.lit(1))
    kept = F.count_if("keep")
    return marked.agg(
        kept.alias("scanned_files"),
        (total - kept).alias("pruned_files"),
        F.when(total > 0, (total - kept) * 100.0 / total)
        .otherwise(F.lit(0.0))
        .alias("pruned_percent"),
        F.coalesce(F.sum(F.when(F.col("keep"), F.col("record_count"))), F.lit(0)).alias(
            "kept_records"
        ),
    )


def _comparable(path: Column) -> Column:
    """A file path without percent-encoding and with one form of local scheme, as inventories differ in both."""
    # '+' is a literal plus in a path, so it is protected from form decoding
    decoded = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def read_kept(
    spark: SparkSession,
    marked: DataFrame,
    schema: T.StructType,
    root: str,
    file_format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows of the kept files of the table at `root`.

    The table is read as one scan, so partition columns come from its folders and the caller's
    filters prune folders and row groups; the kept files are met by a semi-join on the file path.
    """
    kept = marked.where("keep").select(F.xxhash64(_comparable(F.col("file_path"))).alias("__h"), _comparable(F.col("file_path")).alias("__p"))
    rows = spark.read.schema(schema).format(file_format).options(**(options or {})).load(root)
    rows = rows.select("*", F.col("_metadata.file_path").alias("__file"))
    path = _comparable(F.col("__file"))
    met = (F.xxhash64(path) == F.col("__h")) & (path == F.col("__p"))
    return rows.join(broadcast_if_bounded(kept), met, "left_semi").select(*[F.col(f"`{c}`") for c in schema.names])
