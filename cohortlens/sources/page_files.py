"""A data source of cached pages, for batches and streams.

A page is a file `<stem>.html` directly in a folder; the stem is the slug of what the
page is about (`functions.text.slug`). Empty files are pages that were never fetched:
they are left out at the listing and never opened. A row is a page: where it lies, its
stem, length and time, and with the option `content` its text (`html`, UTF-8; bytes
that are none become the replacement character).

    register(spark)
    spark.read.format("page_files").option("content", "true").load(folder)

`partitionBytes` and the order of a stream are those of `report_files`. A page that is
fetched again has a new time, so a stream takes it again; `newest` keeps the last one
of each stem.

Written rows need `stem` and `html`; each becomes one file, put in place of an older page
of that stem when it is whole. Null and empty pages are not written, so they leave an
older page as it is. Of rows with the same stem one stays. A null stem, or one that is
not a plain file name, is refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import functions as F

from . import report_files

ENDING = ".html"
LISTED = [
    ("path", "string", pa.string()), ("stem", "string", pa.string()), ("length", "long", pa.int64()),
    ("modified", "timestamp", pa.timestamp("us", "UTC")),
]


def listing(folder: str) -> list[tuple]:
    """Rows of `LISTED` with the time in nanoseconds, by time and path."""
    files, root = fs.FileSystem.from_uri(folder)
    rows = []
    for info in files.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        name = info.base_name
        if info.is_file and info.size and name.endswith(ENDING) and not name.startswith("."):
            rows.append((info.path, name[: -len(ENDING)], info.size, info.mtime_ns))
    return sorted(rows, key=lambda r: (r[-1], r[0]))


class _Pages(report_files.Read):
    listed, body = LISTED, ("html", pa.string())

    def listing(self) -> list[tuple]:
        return listing(self.folder)

    def wanted(self, row: tuple) -> bool:
        return True

    def _batch(self, rows: list[tuple], bodies: list[bytes]) -> pa.RecordBatch:
        return super()._batch(rows, [b.decode("utf-8", "replace") for b in bodies])


class Batch(_Pages, report_files.Batch):
    pass


class Stream(_Pages, report_files.Stream):
    pass


class Writer(D.DataSourceArrowWriter):
    def __init__(self, folder: str) -> None:
        self.folder = folder

    def write(self, iterator: Iterator[pa.RecordBatch]) -> D.WriterCommitMessage:
        files, root = fs.FileSystem.from_uri(self.folder)
        files.create_dir(root, recursive=True)
        for batch in iterator:
            for stem, page in zip(batch.column("stem").to_pylist(), batch.column("html").to_pylist()):
                if not stem or "/" in stem or stem.startswith("."):
                    raise ValueError(f"not the stem of a page: {stem}")
                if page:
                    report_files.put(files, root, stem + ENDING, page.encode("utf-8"))
        return D.WriterCommitMessage()


class PageFiles(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return "page_files"

    def schema(self) -> str:
        columns = [f"{name} {kind}" for name, kind, _ in LISTED]
        return ", ".join([*columns, "html string"] if self.options.get("content", "false").lower() == "true" else columns)

    def reader(self, schema) -> Batch:
        return Batch(self.options)

    def streamReader(self, schema) -> Stream:
        return Stream(self.options)

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(PageFiles)


def newest(pages: DataFrame) -> DataFrame:
    """(stem, html): of the pages a stream took, the last of each stem."""
    last = F.max(F.struct("modified", "html")).alias("p")
    return pages.groupBy("stem").agg(last).select("stem", "p.html")
