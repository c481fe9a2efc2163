"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.session import shared_folder

#: ASCII white space, as the contracts state it.
SPACE = r"[\x20\x09-\x0D]"
#: Bytes of the batches in which texts go to Python and back. By rows alone (10 000) a batch of whole texts is some 35 MB, held by
#: Spark and by the worker at once.
BATCH = 2 << 20


def in_small_batches(docs: DataFrame) -> DataFrame:
    """`docs`, with its session told to hand at most about `BATCH` bytes to a worker at once; a longer row goes alone."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))
    return docs


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a table in the shared folder and read it again, which cuts lineage and survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` evaluated once, however often `use` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_of(text: Column) -> Column:
    """Words between ASCII white space; none for a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `limit` bytes of text each; one longer text makes a slice of its own."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(size):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[str]:
    return ["" if t is None else t for t in batch.column(text).to_pylist()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
