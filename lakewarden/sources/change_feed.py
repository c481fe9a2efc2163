"""Version-ordered change feed: batches, watermarks, retention, event shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.fixed_values import FEED_BATCH_DEFAULT, FEED_BATCH_MAX
from lakewarden.functions.text import require_identifier


def clamp_batch(size: int | None) -> int:
    size = FEED_BATCH_DEFAULT if not size or size <= 0 else size
    return min(size, FEED_BATCH_MAX)


def feed_versions(changes: DataFrame, table: Sequence[str] = (), version: str = "version"):
    """Current and minimum valid version, per table when table columns are named."""
    return changes.groupBy(*table).agg(
        F.max(version).alias("current_version"), F.min(version).alias("min_valid_version")
    )


def resume_version(last_version: int, min_valid_version: int | None) -> tuple[int, bool]:
    """Start version and whether a full resync is needed because retention passed it."""
    if min_valid_version is not None and last_version < min_valid_version:
        return max(0, min_valid_version - 1), True
    return last_version, False


def operation_name(op: Column) -> Column:
    code = F.upper(F.btrim(op))
    return (
        F.when(code == "I", F.lit("Insert"))
        .when(code == "D", F.lit("Delete"))
        .otherwise(F.lit("Update"))
    )


def change_batch(
    changes: DataFrame,
    base: DataFrame,
    keys: Sequence[str],
    last_version: int,
    batch_size: int | None = None,
    version: str = "version",
    op: str = "op",
) -> DataFrame:
    """Next changes after `last_version`, with the base row (null when deleted).

    The batch ends at a version boundary: the version holding the n-th change is taken whole,
    so the next watermark never skips a part of it. Only that version number is looked up (a
    bounded top-n), and the batch is then a plain range filter on the feed.
    """
    for k in keys:
        require_identifier(k)
    n = clamp_batch(batch_size)
    pending = changes.where(F.col(version) > last_version)
    cutoff = (
        pending.select(version).orderBy(version).limit(n).agg(F.max(version).alias("v")).scalar()
    )
    return with_base_rows(pending.where(F.col(version) <= cutoff), base, keys, version, op)


def with_base_rows(
    changes: DataFrame, base: DataFrame, keys: Sequence[str], version: str = "version", op: str = "op"
) -> DataFrame:
    """`version`, `operation` and the base row of each change; a deleted row has its key only."""
    for k in keys:
        require_identifier(k)
    picked = changes.select(
        F.col(version).alias("__version"),
        operation_name(F.col(op)).alias("operation"),
        *[F.col(k).alias(f"__pk_{k}") for k in keys],
    )
    rows = base.select(*[F.col(c).alias(f"__b_{c}") for c in base.columns])
    on = [F.col(f"__pk_{k}") == F.col(f"__b_{k}") for k in keys]
    joined = picked.join(rows, on, "left")
    columns = [
        (F.coalesce(F.col(f"__pk_{c}"), F.col(f"__b_{c}")) if c in keys else F.col(f"__b_{c}"))
        .alias(c)
        for c in base.columns
    ]
    return joined.select(F.col("__version").alias("version"), "operation", *columns)


def feed_events(
    batch: DataFrame, domain: str, table_name: str, keys: Sequence[str], tenant: str | None = None
) -> DataFrame:
    """Change events of a batch: id from table, version and all key parts; deletes carry the key."""
    rows = [c for c in batch.columns if c not in ("version", "operation")]
    if tenant is None:
        tenant = next((c for c in rows if c.lower() in ("tenantid", "tenant_id")), None)
    key_row = F.struct(*[F.col(k) for k in keys])
    deleted = F.col("operation") == "Delete"
    return batch.select(
        F.concat_ws(
            "_",
            F.lit(domain),
            F.lit(table_name),
            F.col("version").cast("string"),
            *[F.col(k).cast("string") for k in keys],
        ).alias("event_id"),
        F.lit(domain).alias("domain"),
        F.lit(table_name).alias("table_name"),
        "operation",
        (F.col(tenant).cast("string") if tenant else F.lit(None).cast("string")).alias("tenant_id"),
        F.when(deleted, F.to_json(key_row)).alias("before"),
        F.when(~deleted, F.to_json(F.struct(*rows))).alias("after"),
        "version",
    )


def next_watermark(batch: DataFrame, last_version: int, version: str = "version") -> DataFrame:
    """Monotone watermark after a batch."""
    return batch.agg(
        F.greatest(F.lit(last_version).cast("bigint"), F.max(version).cast("bigint")).alias(
            "watermark"
        )
    )
