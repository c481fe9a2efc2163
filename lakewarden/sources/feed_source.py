"""A landed change feed as a streaming source whose offsets are versions.

    spark.dataSource.register(ChangeFeed)
    spark.readStream.format("change_feed").schema("version long, op string, id long").load(path)

The stream's checkpoint holds the last version that was worked off, so there is no watermark table.
Files are Parquet with a column `version`; a version lands whole, and later files hold later
versions. The driver reads footers only, tasks read the files whose versions are asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lakewarden.sources.inventory import located


@dataclass
class VersionRange(InputPartition):
    path: str
    after: int
    upto: int


class ChangeFeed(DataSource):
    """Options: `path`; `version`, its column's name; `startAfter`, the version before the first one wanted."""

    @classmethod
    def name(cls) -> str:
        return "change_feed"

    def streamReader(self, schema: StructType) -> FeedReader:
        return FeedReader(self.options, schema)


class FeedReader(DataSourceStreamReader):
    def __init__(self, options, schema: StructType):
        self.path, self.schema = options["path"], schema
        self.version = options.get("version", "version")
        self.start_after = options.get("startAfter")
        self.bounds: dict[str, tuple[int, int]] = {}  # of each file, once its footer was read

    def _files(self) -> dict[str, tuple[int, int]]:
        """First and last version of every file, from row-group statistics."""
        files, root = located(self.path)
        found = files.get_file_info(pyarrow.fs.FileSelector(root, recursive=True, allow_not_found=True))
        paths = [f.path for f in found if f.is_file and f.base_name.endswith(".parquet") and f.base_name[0] not in "._"]
        for path in paths:
            if path not in self.bounds:
                with files.open_input_file(path) as file:
                    self.bounds[path] = self._bounds(pq.ParquetFile(file))
        # a file without rows has no versions
        return {p: self.bounds[p] for p in paths if self.bounds[p][0] <= self.bounds[p][1]}

    def _bounds(self, file: pq.ParquetFile) -> tuple[int, int]:
        column = file.schema_arrow.get_field_index(self.version)
        low, high = 2**63 - 1, -(2**63)
        for i in range(file.metadata.num_row_groups):
            seen = file.metadata.row_group(i).column(column).statistics
            if seen is None or not seen.has_min_max:  # then the column itself is read
                values = file.read_row_group(i, [self.version]).column(0).drop_null()
                least, most = (min(values.to_pylist()), max(values.to_pylist())) if len(values) else (low, high)
            else:
                least, most = seen.min, seen.max
            low, high = min(low, least), max(high, most)
        return low, high

    def initialOffset(self) -> dict:
        if self.start_after is not None:
            return {"version": int(self.start_after)}
        files = self._files()
        return {"version": min(low for low, _ in files.values()) - 1 if files else -1}

    def latestOffset(self) -> dict:
        files = self._files()
        last = max((high for _, high in files.values()), default=-1)
        return {"version": max(last, self.initialOffset()["version"])}

    def partitions(self, start: dict, end: dict) -> list[VersionRange]:
        after, upto = start["version"], end["version"]
        files = self._files()
        oldest = min((low for low, _ in files.values()), default=after + 1)
        if oldest > after + 1 and after >= 0 and self.start_after is None:
            raise RuntimeError(f"versions after {after} up to {oldest} are no longer kept: a full resync is needed")
        return [VersionRange(p, after, upto) for p, (low, high) in sorted(files.items()) if high > after and low <= upto]

    def read(self, partition: VersionRange) -> Iterator[pa.RecordBatch]:
        files, _ = located(self.path)
        wanted = to_arrow_schema(self.schema)
        version = ds.field(self.version)
        rows = ds.dataset(partition.path, filesystem=files, format="parquet").scanner(
            columns=wanted.names, filter=(version > partition.after) & (version <= partition.upto)
        )
        for batch in rows.to_batches():
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(f.name).cast(f.type) for f in wanted], schema=wanted)
