"""Apply change events to a snapshot; activity per time window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_changes(
    events: DataFrame, keys: Sequence[str], order: Sequence[str], operation: str = "operation"
) -> DataFrame:
    """Last event per key by `order`; a delete wins a tie.

    A partial aggregation, not a window: copies of a hot key shrink to one row per task.
    """
    deleted = F.col(operation) == "Delete"
    rank = F.struct(*[F.col(c) for c in order], deleted.alias("__del"))
    rest = [c for c in events.columns if c not in keys]
    picked = events.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("__row"))
    return picked.select(*keys, "__row.*")


def apply_changes(
    target: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    operation: str = "operation",
    version: str | None = None,
    deleted: str | None = None,
) -> DataFrame:
    """New snapshot: inserts and updates replace rows, deletes remove them.

    With `version`, a column of both sides, changes that are not newer than the stored row are
    ignored. `deleted` names a boolean column of the target in which a delete leaves its key and
    version behind; only then does a change that comes after a newer delete change nothing.
    """
    keys = list(keys)
    latest = latest_changes(events, keys, order, operation)
    values = [c for c in target.columns if c not in keys]
    if deleted is not None:
        latest = latest.withColumn(deleted, F.col(operation) == "Delete")
    old = target.select(*keys, F.struct(*values).alias("__old"))
    new = latest.select(
        *keys,
        F.struct(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in values]).alias(
            "__new"
        ),
        F.col(operation).alias("__op"),
    )
    joined = old.join(new, keys, "full_outer")
    changed = F.col("__op").isNotNull()
    if version is not None:
        fresh = F.col("__old").isNull() | (F.col(f"__new.{version}") > F.col(f"__old.{version}"))
        changed = changed & fresh
    kept = joined
    if deleted is None:
        kept = joined.where(~(changed & (F.col("__op") == "Delete")))
    row = F.when(changed, F.col("__new")).otherwise(F.col("__old"))
    return (
        kept.select(*keys, row.alias("__r"))
        .where(F.col("__r").isNotNull())
        .select(*[F.col(c) if c in keys else F.col(f"__r.{c}") for c in target.columns])
    )


def activity_windows(
    events: DataFrame, at: str, by: Sequence[str], width: str = "1 minute"
) -> DataFrame:
    """Events per tumbling window and group; the same for batch and stream."""
    counted = events.groupBy(F.window(F.col(at), width).alias("w"), *by).agg(
        F.count(F.lit(1)).alias("events")
    )
    return counted.select(F.col("w.start").alias("window_start"), *by, "events")
