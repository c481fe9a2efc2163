"""Inventories from footers against inventories from whole scans."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakewarden.sources.inventory import build_inventory, inventory_from_footers

COLUMNS = ["id", "day", "at", "price", "name", "ratio", "nothing"]


def table(spark):
    return spark.range(60).selectExpr(
        "id",
        "date_add(date'2024-01-01', cast(id as int)) AS day",
        "timestamp_seconds(id * 1000) AS at",
        "cast(id as decimal(12,2)) / 7 AS price",
        "if(id % 5 = 0, null, concat('é', id)) AS name",
        "id / 3.0D AS ratio",
        "cast(null as string) AS nothing",
        "concat('a b/', id % 2) AS part",
        "if(id % 3 = 0, null, cast(id % 3 as int)) AS number",
    )


@pytest.mark.parametrize("timestamps", ["INT96", "TIMESTAMP_MICROS"])
def test_footers_tell_what_a_scan_tells(spark, rows, tmp_path, timestamps):
    root = str(tmp_path / "t")
    writer = table(spark).repartition(3).write.partitionBy("part", "number").option("parquet.block.size", 1)
    spark.conf.set("spark.sql.parquet.outputTimestampType", timestamps)
    try:
        writer.parquet(root)
    finally:
        spark.conf.unset("spark.sql.parquet.outputTimestampType")
    df = spark.read.parquet(root)
    columns = ["file_path", "file_format", "partition", "record_count", "file_size", "lower_bounds", "upper_bounds"]
    got = inventory_from_footers(spark, root, df.schema, COLUMNS, ["part", "number"])
    want = build_inventory(df, COLUMNS, ["part", "number"])
    key = lambda r: r["file_path"]
    assert [r.asDict() for r in sorted(got.select(*columns).collect(), key=key)] == [r.asDict() for r in sorted(want.select(*columns).collect(), key=key)]


def test_files_without_statistics_are_read(spark, rows, tmp_path):
    root = tmp_path / "t"
    root.mkdir()
    data = pa.table({"id": pa.array([3, None, 9, 1], pa.int64()), "name": ["b", None, "a", "c"]})
    pq.write_table(data, root / "plain.parquet", write_statistics=False, row_group_size=2)
    pq.write_table(data.slice(0, 0), root / "empty.parquet")
    pq.write_table(data.select(["id"]), root / "narrow.parquet")
    df = spark.read.schema("id long, name string").parquet(str(root))
    got = inventory_from_footers(spark, str(root), df.schema, ["id", "name"])
    seen = {r["file_path"].rsplit("/", 1)[1]: (r["record_count"], r["lower_bounds"], r["upper_bounds"]) for r in got.collect()}
    assert seen == {
        "plain.parquet": (4, {"id": "1", "name": "a"}, {"id": "9", "name": "c"}),
        "empty.parquet": (0, {}, {}),
        "narrow.parquet": (4, {"id": "1"}, {"id": "9"}),
    }
    assert got.agg(F.sum("record_count")).first()[0] == df.count()
