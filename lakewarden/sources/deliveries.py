"""Landed webhook deliveries as batch or streaming source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.fixed_values import MAX_PAYLOAD_BYTES

DELIVERY_SCHEMA = (
    "payload string, signature string, sent_at timestamp, raw_timestamp string, "
    "instance string, received_at timestamp"
)


def read_deliveries(spark: SparkSession, path: str, file_format: str = "json") -> DataFrame:
    return spark.read.schema(DELIVERY_SCHEMA).format(file_format).load(path)


def stream_deliveries(
    spark: SparkSession, path: str, file_format: str = "json", files_per_trigger: int = 1000
) -> DataFrame:
    return (
        spark.readStream.schema(DELIVERY_SCHEMA)
        .format(file_format)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(path)
    )


def quarantine_oversized(
    deliveries: DataFrame, cap: int = MAX_PAYLOAD_BYTES
) -> tuple[DataFrame, DataFrame]:
    """Deliveries within the read cap, and the rest."""
    size = F.coalesce(F.octet_length("payload"), F.lit(0))
    return deliveries.where(size <= cap), deliveries.where(size > cap)
