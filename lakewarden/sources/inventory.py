"""File inventory (row count, min/max per column) of real Parquet files."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from decimal import Context, Decimal
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakewarden.functions.paths import bucket_of


def build_inventory(
    df: DataFrame,
    bounds: Iterable[str],
    partition: Iterable[str] = (),
    file_path: Column | None = None,
    file_size: Column | None = None,
) -> DataFrame:
    """One row per file of `df` with string bounds of the named columns.

    Only the named columns are scanned. The aggregation is combined per task before the one
    shuffle, whose rows number files, not data rows. A column that is null throughout a file
    gets no bounds there.
    """
    bounds, partition = list(bounds), list(partition)
    path = F.col("_metadata.file_path") if file_path is None else file_path
    if file_size is None:
        file_size = (
            F.col("_metadata.file_size") if file_path is None else F.lit(None).cast("bigint")
        )
    # metadata columns have to be selected before they can be grouped on
    scan = df.select(path.alias("__path"), file_size.alias("__size"), *{*bounds, *partition})
    aggs = [F.count(F.lit(1)).alias("record_count"), F.max("__size").alias("file_size")]
    for c in bounds:
        aggs += [F.min(c).cast("string").alias(f"__lo_{c}")]
        aggs += [F.max(c).cast("string").alias(f"__hi_{c}")]
    for c in partition:
        aggs += [F.min(c).cast("string").alias(f"__p_{c}")]
    return _as_inventory(scan.groupBy("__path").agg(*aggs), bounds, partition)


def _as_inventory(grouped: DataFrame, bounds: list[str], partition: list[str]) -> DataFrame:
    """Inventory columns from `(__path, record_count, file_size, __lo_*, __hi_*, __p_*)`, all bounds as strings."""

    def packed(prefix: str, names: list[str]) -> Column:
        if not names:
            return F.create_map().cast("map<string,string>")
        entries = F.array(
            *[
                F.struct(F.lit(c.lower()).alias("k"), F.col(f"{prefix}{c}").alias("v"))
                for c in names
            ]
        )
        return F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull()))

    return grouped.select(
        F.col("__path").alias("file_path"),
        F.lit("PARQUET").alias("file_format"),
        packed("__p_", partition).alias("partition"),
        "record_count",
        "file_size",
        packed("__lo_", bounds).alias("lower_bounds"),
        packed("__hi_", bounds).alias("upper_bounds"),
    )


def inventory_from_footers(
    spark: SparkSession, root: str, schema: StructType, bounds: Iterable[str], partition: Iterable[str] = ()
) -> DataFrame:
    """`build_inventory` of the Parquet files below `root`, read from their footers.

    Tasks open the files and add up the bounds of row groups, so what is read does not grow with
    the rows. Where a row group has no statistics for a column (Spark's old timestamps, texts of some
    writers), that column of that row group is read. `schema` is the table's. Partition columns come
    from the folders. Needs a store that Arrow can open; elsewhere `build_inventory` scans.
    """
    bounds, partition = list(bounds), list(partition)
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(root)
        .select(F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_size").alias("file_size"))
    )
    typed = StructType([StructField("__path", StringType()), StructField("file_size", LongType()), StructField("record_count", LongType())])
    for c in bounds:
        for side in ("lo", "hi"):
            typed.add(f"__{side}_{c}", schema[c].dataType)
    wanted = to_arrow_schema(typed)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, size in zip(batch.column("__path").to_pylist(), batch.column("file_size").to_pylist()):
                store, name = located(path)
                with store.open_input_file(name) as opened:
                    rows.append({"__path": path, "file_size": size, **_footer(pq.ParquetFile(opened), bounds)})
            yield pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in wanted], schema=wanted)

    found = files.mapInArrow(read, typed)
    for c in partition:
        value = F.regexp_extract("__path", f"/{re.escape(quote(c))}=([^/]*)/", 1)
        value = F.when(value == "__HIVE_DEFAULT_PARTITION__", None).otherwise(F.url_decode(F.url_decode(F.replace(value, F.lit("+"), F.lit("%252B")))))
        found = found.withColumn(f"__p_{c}", value.cast(schema[c].dataType).cast("string"))
    texts = {f"__{side}_{c}": F.col(f"__{side}_{c}").cast("string") for c in bounds for side in ("lo", "hi")}
    return _as_inventory(found.withColumns(texts) if texts else found, bounds, partition)


def located(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """Store and name in it of a file as Spark names it, URL-encoded, or of a plain local path."""
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + unquote(path.removeprefix("file:")).lstrip("/")
    if "://" not in path:
        return pyarrow.fs.LocalFileSystem(), path
    return pyarrow.fs.FileSystem.from_uri(path)


def _decimal(raw: int | bytes, kind: pa.DataType) -> Decimal:
    """A decimal from its unscaled value, which the file holds as a number or as bytes."""
    digits = raw if isinstance(raw, int) else int.from_bytes(raw, "big", signed=True)
    return Decimal(digits).scaleb(-kind.scale, Context(prec=kind.precision))


def _ends(seen: pq.Statistics | None, kind: pa.DataType) -> tuple | None:
    """Least and greatest value by the statistics, None where these do not tell."""
    if seen is None or not seen.has_min_max:
        return None
    if pa.types.is_decimal(kind):
        return _decimal(seen.min_raw, kind), _decimal(seen.max_raw, kind)
    try:
        return seen.min, seen.max
    except pa.ArrowNotImplementedError:  # Spark's old timestamps, whose statistics are of no use
        return None


def _footer(file: pq.ParquetFile, bounds: list[str]) -> dict:
    """Row count and bounds of one file; a column that it lacks or that is null throughout has none."""
    out = {"record_count": file.metadata.num_rows}
    for c in bounds:
        index = file.schema_arrow.get_field_index(c)
        values = []
        for i in range(file.metadata.num_row_groups if index >= 0 else 0):
            group = file.metadata.row_group(i)
            seen = group.column(index).statistics
            if seen is not None and seen.has_null_count and seen.null_count == group.num_rows:
                continue
            ends = _ends(seen, file.schema_arrow.field(index).type)
            if ends is None:
                ends = tuple(pc.min_max(file.read_row_group(i, [c]).column(0).combine_chunks()).as_py().values())
            values += [v for v in ends if v is not None]
        out[f"__lo_{c}"], out[f"__hi_{c}"] = min(values, default=None), max(values, default=None)
    return out


def allowed_buckets(configured: DataFrame, locations: DataFrame) -> DataFrame:
    """Distinct buckets: configured names (`bucket`) and those of table locations (`location`)."""
    named = configured.select(F.btrim("bucket").alias("bucket"))
    derived = locations.select(bucket_of(F.col("location")).alias("bucket"))
    return named.unionByName(derived).where(F.coalesce("bucket", F.lit("")) != "").distinct()


def check_buckets(files: DataFrame, allowed: DataFrame, path: str = "file_path") -> DataFrame:
    """Adds `bucket` and `bucket_allowed`; an empty allow-list restricts nothing."""
    marked = allowed.select(F.col("bucket").alias("__b"), F.lit(True).alias("__ok"))
    unrestricted = allowed.agg((F.count(F.lit(1)) == 0).alias("u")).scalar()
    return (
        files.withColumn("bucket", bucket_of(F.col(path)))
        .join(marked, F.col("bucket") == F.col("__b"), "left")
        .withColumn(
            "bucket_allowed",
            F.coalesce(F.col("__ok"), F.lit(False)) | unrestricted | F.col("bucket").isNull(),
        )
        .drop("__b", "__ok")
    )
