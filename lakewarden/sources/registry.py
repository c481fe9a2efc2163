"""Table registry: name to location, format, partition columns and sensitivity."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class LakeTable:
    location: str
    format: str = "parquet"
    partition_columns: tuple[str, ...] = ()
    sensitivity: str = "NORMAL"
    options: Mapping[str, str] = field(default_factory=dict)


class TableRegistry:
    def __init__(self, tables: Mapping[str, LakeTable]):
        self._tables = {name.lower(): table for name, table in tables.items()}

    def find(self, name: str) -> LakeTable | None:
        return self._tables.get(name.lower())

    def read(self, spark: SparkSession, name: str, schema: T.StructType | None = None) -> DataFrame:
        """Rows of a table; an unknown name gives an empty result, not an error."""
        table = self.find(name)
        if table is None:
            return spark.createDataFrame([], schema or T.StructType([]))
        reader = spark.read.format(table.format).options(**table.options)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.load(table.location)
