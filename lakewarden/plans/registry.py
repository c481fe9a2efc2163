"""Register of named queries and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Rows of near or repeated values take some twenty times the bytes of their Parquet file. Estimated by the
# file alone, a million rows pass for less than the broadcast threshold and go through the driver.
FILE_COMPRESSION = "25"
# A task joins, sorts and aggregates what it reads in memory, at some twenty times its compressed bytes and in
# several operators at once. With small limits for what one task reads, larger tables make more tasks, not larger ones.
TASK_BYTES = {"spark.sql.files.maxPartitionBytes": "32m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m"}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function name, with comparison SQL when there is any."""

    def register(fn: Query) -> Query:
        @wraps(fn)
        def in_session(spark: SparkSession, sf_dir: str) -> DataFrame:
            # the tables' timestamps have no zone and are read as UTC
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            spark.conf.set("spark.sql.sources.fileCompressionFactor", FILE_COMPRESSION)
            for limit, size in TASK_BYTES.items():
                spark.conf.set(limit, size)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = in_session
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return register
