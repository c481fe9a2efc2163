"""Publishing a version-ordered change feed as events."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lakewarden.sources.change_feed import feed_events, with_base_rows


def publish_feed(
    changes: DataFrame,
    base: DataFrame,
    keys: Sequence[str],
    domain: str,
    table_name: str,
    publish: Callable[[DataFrame, int], None],
    checkpoint_location: str,
    **trigger,
) -> StreamingQuery:
    """Hands the events of every micro-batch of a feed (`sources.feed_source`) to `publish(events, batch_id)`.

    The last version is in the checkpoint and moves only after `publish` returned. A stream that is
    stopped in between runs the same versions again, whose events have the same ids. Rows that land
    meanwhile have later versions and wait for the next micro-batch.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        publish(feed_events(with_base_rows(batch, base, keys), domain, table_name, keys), batch_id)

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint_location)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
