"""Session defaults, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROW_BOUND = 100_000


def build_session(app: str = "lakewarden", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution, UTC and Arrow; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # keyed streams keep rows of hot keys in the state store, so it has to be on disk
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    defaults.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in defaults.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in `spark.checkpoint.dir`.

    Only a local master without that setting gets a folder of its own, since no other machine has
    to read it.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    if sc.applicationId not in _OWN:
        _OWN[sc.applicationId] = tempfile.mkdtemp(prefix="lakewarden-")
    return _OWN[sc.applicationId]


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of `df` with a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, name: str, compression: str | None = None, folder: str | None = None) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it again: made once, however often it is used."""
    path = f"{folder or shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a stored table or folder that nothing reads any more."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch_folder(spark: SparkSession) -> Iterator[str]:
    """A folder in the shared folder for tables that only the jobs in here read; it goes at the end."""
    path = f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        remove(spark, path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs that run in here remove their shuffle files as they end.

    Without it those stay on disk until the driver happens to collect its garbage, so a query of
    several jobs holds the shuffles of all. Only for jobs whose result is stored or sent to the driver.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def broadcast_if_bounded(df: DataFrame, rows: int = BROADCAST_ROW_BOUND) -> DataFrame:
    """Broadcast hint only after counting at most `rows` rows; beyond it the plain DataFrame.

    The plain DataFrame still joins correctly by a shuffle, so nothing depends on the bound.
    """
    if df.limit(rows + 1).count() <= rows:
        return F.broadcast(df)
    return df
