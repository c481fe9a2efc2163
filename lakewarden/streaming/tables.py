"""Plain Parquet tables that micro-batches write with Spark's dynamic partition overwrite."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def path_exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def read_table(spark: SparkSession, root: str, schema: StructType | str) -> DataFrame:
    """The table, or no rows of that schema before the first write."""
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not path_exists(spark, root):
        return spark.createDataFrame([], wanted)
    return spark.read.schema(wanted).parquet(root).select(*wanted.names)


def overwrite_partitions(df: DataFrame, root: str, *by: str) -> None:
    """Replaces the partitions that `df` has rows for, and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(root)


def write_batch(df: DataFrame, root: str, batch_id: int) -> None:
    """The rows of one micro-batch as the partition `batch_id`; a batch that is run again replaces its own rows."""
    overwrite_partitions(df.withColumn("batch_id", F.lit(batch_id).cast("bigint")), root, "batch_id")


def upsert_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    schema: StructType,
    keys: Sequence[str],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    buckets: int = 64,
) -> None:
    """`merge(old rows, batch)` written over the partitions `bucket` of `root` that the batch's keys fall into.

    `merge` must not take the last row from a bucket, so deletes stay as marked rows. The merged rows
    are staged first: a partition is replaced by removing it and moving another in, and a stream that
    stops in between finds the rows of its micro-batch staged and moves them in again.
    """
    spark, staged = batch.sparkSession, f"{root}-staged"
    run = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}:{batch_id}"
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")
    with_bucket = StructType([*schema.fields]).add("bucket", "integer")
    marked = StructType([*with_bucket.fields]).add("run", "string")

    def is_staged() -> bool:
        if not path_exists(spark, f"{staged}/_SUCCESS"):
            return False
        first = spark.read.schema(marked).parquet(staged).select("run").first()
        return first is not None and first["run"] == run

    if not is_staged():
        touched = [r["bucket"] for r in batch.select(bucket).distinct().collect()]  # at most one row a bucket
        old = read_table(spark, root, with_bucket).where(F.col("bucket").isin(touched)).drop("bucket")
        merge(old, batch).select(*schema.names, bucket, F.lit(run).alias("run")).write.mode("overwrite").parquet(staged)
    rows = spark.read.schema(marked).parquet(staged).drop("run")
    overwrite_partitions(rows.repartition("bucket"), root, "bucket")
