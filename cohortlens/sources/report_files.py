"""A data source of report files, for batches and streams.

Files are named `<type>_<year>_<semester>_<college>.<ending>` (see
`operators.worklist.report_path`) and lie anywhere below a folder; others are not
looked at. A row is a file: where it lies, the parts of its name, its length and
time, and with the option `content` its bytes.

    register(spark)
    spark.read.format("report_files").option("content", "true").option("firstYear", 2020).load(folder)

The options `firstYear`, `lastYear`, `colleges` and `reportTypes` (lists with commas)
are settled at the listing, so that other files are never opened. They are options and
not conditions that Spark hands down: Spark keeps one reader for a loaded table, and
two branches of a plan with unlike conditions would read each other's files. Files
are packed into partitions of `partitionBytes`. A stream goes on after the time and
path of the last file it took; a file that turns up with an older time is not seen by
it (for that, and for files that grow, see `streaming.arrivals`).

Written rows need the parts of a name and a content; each becomes one file, put in
place of one of that name when it is whole. Of rows with the same name one stays.
Nulls in the parts of a name are refused.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import datasource as D

NAME = re.compile(r"(?P<report_type>[a-z]+)_(?P<year>[0-9]{4})_(?P<semester>[1-3])_(?P<college>[^/.]+)\.[^/.]+")
LISTED = [
    ("path", "string", pa.string()), ("report_type", "string", pa.string()), ("year", "int", pa.int32()),
    ("semester", "int", pa.int32()), ("college", "string", pa.string()), ("length", "long", pa.int64()),
    ("modified", "timestamp", pa.timestamp("us", "UTC")),
]
# Bytes of content in one batch, files in one partition.
BATCH_BYTES, MOST_FILES = 8 << 20, 10_000


def listing(folder: str) -> list[tuple]:
    """Rows of `LISTED` with the time in nanoseconds, by time and path."""
    files, root = fs.FileSystem.from_uri(folder)
    rows = []
    for info in files.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
        found = NAME.fullmatch(info.base_name)
        if info.is_file and found:
            rows.append((info.path, found["report_type"], int(found["year"]), int(found["semester"]), found["college"], info.size, info.mtime_ns))
    return sorted(rows, key=lambda r: (r[-1], r[0]))


def _names(option: str | None) -> frozenset[str] | None:
    return None if option is None else frozenset(x.strip() for x in option.split(","))


class Slice(D.InputPartition):
    def __init__(self, rows: list[tuple]) -> None:
        self.rows = rows


class Read:
    """What batches and streams share: packing files and reading them.

    The listing gives rows of `listed`, by time and path; the last two values are length and time.
    """

    listed, body = LISTED, ("content", pa.binary())

    def __init__(self, options: dict[str, str]) -> None:
        self.folder = options["path"]
        self.content = options.get("content", "false").lower() == "true"
        self.most = int(options.get("partitionBytes", 128 << 20))
        self.years = int(options.get("firstYear", 0)), int(options.get("lastYear", 9999))
        self.colleges, self.types = (_names(options.get(n)) for n in ("colleges", "reportTypes"))

    def listing(self) -> list[tuple]:
        return listing(self.folder)

    def wanted(self, row: tuple) -> bool:
        _, kind, year, _, college, *_ = row
        first, last = self.years
        return first <= year <= last and (self.colleges is None or college in self.colleges) and (self.types is None or kind in self.types)

    def packed(self, rows: list[tuple]) -> list[Slice]:
        """The wanted files, so many to a partition."""
        slices, size = [], 0
        for row in filter(self.wanted, rows):
            if not slices or size + row[-2] > self.most or len(slices[-1].rows) == MOST_FILES:
                slices.append(Slice([]))
                size = 0
            slices[-1].rows.append(row)
            size += row[-2]
        return slices

    def read(self, partition: Slice | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark's way to read no partitions
            return
        files, _ = fs.FileSystem.from_uri(self.folder)
        rows, bodies, size = [], [], 0
        for row in partition.rows:
            rows.append(row)
            if self.content:
                with files.open_input_stream(row[0]) as stream:
                    bodies.append(stream.read())
                size += len(bodies[-1])
                if size > BATCH_BYTES:
                    yield self._batch(rows, bodies)
                    rows, bodies, size = [], [], 0
        if rows:
            yield self._batch(rows, bodies)

    def _batch(self, rows: list[tuple], bodies: list[bytes]) -> pa.RecordBatch:
        *parts, times = zip(*rows)
        times = [datetime.fromtimestamp(t / 1e9, timezone.utc) for t in times]
        arrays = [pa.array(values, kind) for values, (_, _, kind) in zip([*parts, times], self.listed)]
        names = [name for name, _, _ in self.listed]
        if self.content:
            name, kind = self.body
            arrays.append(pa.array(bodies, kind))
            names.append(name)
        return pa.RecordBatch.from_arrays(arrays, names)


class Batch(Read, D.DataSourceReader):
    def partitions(self) -> list[Slice]:
        return self.packed(self.listing())


class Stream(Read, D.DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"modified": -1, "path": ""}

    def latestOffset(self) -> dict:
        rows = self.listing()
        return {"modified": rows[-1][-1], "path": rows[-1][0]} if rows else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        first, last = ((o["modified"], o["path"]) for o in (start, end))
        return self.packed([r for r in self.listing() if first < (r[-1], r[0]) <= last])


def put(files: fs.FileSystem, root: str, name: str, content: bytes) -> None:
    """Write a file under a name that no reader takes, and move it into place when it is whole."""
    begun = f"{root}/.{uuid.uuid4().hex}"
    with files.open_output_stream(begun) as out:
        out.write(content)
    files.move(begun, f"{root}/{name}")


class Writer(D.DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder, self.ending = options["path"], options.get("ending", "txt")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> D.WriterCommitMessage:
        files, root = fs.FileSystem.from_uri(self.folder)
        files.create_dir(root, recursive=True)
        for batch in iterator:
            parts = [batch.column(n).to_pylist() for n in ("report_type", "year", "semester", "college", "content")]
            for *named, content in zip(*parts):
                name = "_".join(map(str, named)) + f".{self.ending}"
                if None in named or not NAME.fullmatch(name):
                    raise ValueError(f"not the name of a report file: {name}")
                put(files, root, name, content or b"")
        return D.WriterCommitMessage()


class ReportFiles(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return "report_files"

    def schema(self) -> str:
        columns = [f"{name} {kind}" for name, kind, _ in LISTED]
        return ", ".join([*columns, "content binary"] if self.options.get("content", "false").lower() == "true" else columns)

    def reader(self, schema) -> Batch:
        return Batch(self.options)

    def streamReader(self, schema) -> Stream:
        return Stream(self.options)

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(ReportFiles)
