"""Words and hashes of texts in Arrow batches, and tables kept between jobs.

A word is a run of bytes other than space and 0x09-0x0D; A-Z is lower-cased
where an operator asks for it. Null texts count as empty.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scale import shared_folder

WORD = r"[^\x20\x09-\x0D]+"
# Bytes hashed at a time; a text beyond it is cut between words.
PIECE = 1 << 20

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_STEP = _rng.integers(1, 2**64, 64, dtype=np.uint64) | np.uint64(1)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, PIECE + 4096)
        _powers[:] = [
            np.concatenate(([np.uint64(1)], np.full(size, b, np.uint64))).cumprod(dtype=np.uint64)
            for b in (_BASE, _BASE_INVERSE)
        ]
    return _powers


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 places where its texts begin."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def word_spans(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each word; no word runs over a boundary in `at`."""
    word = ~SPACE[raw]
    before = np.empty_like(word)
    before[:1] = False
    before[1:] = word[:-1]
    inner = at[(at > 0) & (at < len(raw))]
    begin, end = word & ~before, before & ~word
    begin[inner] |= word[inner]
    end[inner] |= before[inner]
    ends = np.flatnonzero(end)
    if len(word) and word[-1]:
        ends = np.append(ends, len(word))
    return np.flatnonzero(begin), ends


def _hash_piece(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = _power_tables(len(raw) + 1)
    total = np.empty(len(raw) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[raw] * power[: len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_hashes(raw: np.ndarray, at: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and the n + 1 places where each text's words begin."""
    if lower:
        raw = LOWER[raw]
    starts, ends = word_spans(raw, at)
    found, first = [], 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + PIECE, "right")))
        base = starts[first]
        found.append(_hash_piece(raw[base : ends[last - 1]], starts[first:last] - base, ends[first:last] - base))
        first = last
    hashes = np.concatenate(found) if found else np.empty(0, np.uint64)
    return hashes, np.searchsorted(starts, at)


def shingles(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """Distinct, sorted hashes of the runs of `size` words of one text; of all its words if fewer."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, np.uint64)
    width = min(n, size)
    total = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        total += hashes[i : n - width + 1 + i] * _STEP[i]
    return np.unique(mix(total))


def pieces(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `most` bytes of text each, one row at least."""
    at = bytes_of(batch.column(column))[1]
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over batches after which its worker gives memory back.

    Workers are used again by later tasks; what their allocators keep for
    themselves would add up over the stages of a pipeline.
    """

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return wrapped


def strings(column: pa.Array) -> list[str]:
    return column.fill_null("").to_pylist()


def kept(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder of the cluster and read it back.

    The files go with the open `workspace`, or when the program ends.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """`doc_id` and `text` alone, null texts empty."""
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
