"""A streaming source over Parquet files whose micro-batches are bounded by rows.

Spark's file source bounds a batch by files or bytes; feeds here are bounded by rows. Offsets count rows: a file's name and
the rows of it that are done, with files in the order of their names (new files must sort after old ones, as names with times
do). A batch takes the next ``rows`` rows, across files where one ends, cut into ranges that executors read on their own, row
groups outside a range unread. Spark stores the offsets in its checkpoint, so a restarted query goes on at the row after the
last batch; an unfinished batch is read again with the same bounds.

A backlog of many batches need not cost a trigger each: with ``batches`` a trigger takes up to that many batches of ``rows`` rows
at once, and the column that ``number`` names (part of the schema, a long) tells each row's batch, counted from 0 over the whole feed.

    spark.dataSource.register(RowStream)
    spark.readStream.format("parquet_rows").schema(schema).option("path", folder).option("rows", 1000).load()
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Rows of a batch unless the option says otherwise, and rows of a range that one task reads.
ROWS, RANGE = 1_000, 100_000


@dataclass
class Range(InputPartition):
    """Rows ``first`` to ``last`` - 1 of a file; ``before`` rows of the feed come before them."""

    file: str
    first: int
    last: int
    before: int = 0


class RowStream(DataSource):
    """Options: ``path`` (a folder that executors reach), ``rows`` (most rows of a batch), ``batches`` (of a trigger, 1), ``number`` (column)."""

    @classmethod
    def name(cls) -> str:
        return "parquet_rows"

    def streamReader(self, schema) -> DataSourceStreamReader:
        rows, batches = int(self.options.get("rows", ROWS)), int(self.options.get("batches", 1))
        return _Reader(self.options["path"], rows, [f.name for f in schema.fields], batches, self.options.get("number"))


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str, rows: int, columns: list[str], batches: int = 1, number: str | None = None) -> None:
        if rows < 1 or batches < 1:
            raise ValueError("a batch needs at least one row, a trigger at least one batch")
        self.path, self.rows, self.columns, self.batches, self.number = path, rows, columns, batches, number
        self.at: dict | None = None
        self.sizes: dict[str, int] = {}  # of files seen by the driver; footers are read once

    def _store(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)

    def _files(self) -> list[str]:
        store, folder = self._store()
        found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return sorted(f.path for f in found if f.type == fs.FileType.File and f.base_name.endswith(".parquet") and not f.base_name.startswith(("_", ".")))

    def _size(self, file: str) -> int:
        if file not in self.sizes:
            with self._store()[0].open_input_file(file) as opened:
                self.sizes[file] = pq.ParquetFile(opened).metadata.num_rows
        return self.sizes[file]

    def initialOffset(self) -> dict:
        return {"file": "", "rows": 0}

    def latestOffset(self) -> dict:
        """At most ``rows * batches`` rows on from where the last trigger ended."""
        self.at = self.at or self.initialOffset()
        left, end = self.rows * self.batches, dict(self.at)
        for file in self._files():
            if file < end["file"] or not left:
                continue
            done = end["rows"] if file == end["file"] else 0
            taken = min(left, self._size(file) - done)
            if taken > 0:
                end, left = {"file": file, "rows": done + taken, "before": end.get("before", 0) + taken}, left - taken
        self.at = end
        return end

    def partitions(self, start: dict, end: dict) -> list[Range]:
        # A restarted query asks for the last batch's ranges first, which tells where to go on.
        self.at = self.at or end
        out, before = [], start.get("before", 0)
        for file in self._files():
            if start["file"] <= file <= end["file"]:
                first = start["rows"] if file == start["file"] else 0
                last = end["rows"] if file == end["file"] else self._size(file)
                out += [Range(file, a, min(a + RANGE, last), before + a - first) for a in range(first, last, RANGE)]
                before += last - first
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        with self._store()[0].open_input_file(partition.file) as opened:
            source, before, at = pq.ParquetFile(opened), 0, partition.before
            stored = [c for c in self.columns if c != self.number]
            for group in range(source.metadata.num_row_groups):
                size = source.metadata.row_group(group).num_rows
                first, last = max(partition.first - before, 0), min(partition.last - before, size)
                if first < last:
                    rows = source.read_row_group(group, columns=stored).slice(first, last - first)
                    if self.number is not None:
                        rows = rows.append_column(self.number, pa.array(np.arange(at, at + last - first) // self.rows, pa.int64()))
                    yield from rows.select(self.columns).to_batches()
                    at += last - first
                before += size
