"""Document fingerprints from closed syncmers.

A window of `WINDOW` characters is a closed syncmer if the smallest hash of its
inner strings of `INNER` characters stands at its first or last place. That
depends on the window alone, so a passage keeps its anchors wherever it is
moved, and the anchors of an edited text are those of its parts plus the few
windows over the seam.

A fingerprint holds the `ANCHORS` anchors with the smallest hashes, in the order
of their first places, as 8 hex digits each. Two fingerprints are compared
among the `ANCHORS` smallest hashes of both: the likeness is the share of them
that both have and that lie on the longest common order (positional match), an
estimate of the Jaccard similarity of the anchor sets.

Null texts count as empty. An empty text has the empty fingerprint, which is
like itself (1.0) and unlike any other (0.0). A text without a syncmer has the
hash of the whole text as its only anchor. Documents follow one another by
`doc_id` (nulls first), equal ids by their texts.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .texts import bytes_of, mix, pieces, strings, texts

INNER = 8
SPAN = 17  # inner strings in a window
WINDOW = INNER + SPAN - 1
ANCHORS = 128
# Characters taken at a time; pieces overlap by a window, so no anchor is lost.
PIECE = 1 << 18
_A, _A2, _A4, _A8 = (np.uint64(pow(0xD6E8FEB86659FD93, i, 2**64)) for i in (1, 2, 4, 8))
Anchors = tuple[np.ndarray, np.ndarray]


def _windows(codes: np.ndarray) -> Anchors:
    """Places and hashes of the closed syncmers of one piece."""
    n = len(codes) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = (codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h = h[:-1] * _A + h[1:]
    h = h[:-2] * _A2 + h[2:]
    h8 = h[:-4] * _A4 + h[4:]
    inner = mix(h8)
    low = np.minimum(inner[:-1], inner[1:])
    low = np.minimum(low[:-2], low[2:])
    low = np.minimum(low[:-4], low[4:])
    low = np.minimum(low[:-8], low[8:])
    low = np.minimum(low[:n], inner[SPAN - 1 :])
    at = np.flatnonzero((inner[:n] == low) | (inner[SPAN - 1 :] == low))
    return at, mix((h8[at] * _A8 + h8[at + 8]) * _A8 + h8[at + 16]) >> np.uint64(32)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def anchors(text: str) -> Anchors:
    """Places and hashes of all closed syncmers of a text, in order."""
    found = [(0, *_windows(_codes(text[:PIECE])))]
    for begin in range(PIECE - WINDOW + 1, len(text) - WINDOW + 1, PIECE - WINDOW + 1):
        found.append((begin, *_windows(_codes(text[begin : begin + PIECE]))))
    if len(found) == 1:
        return found[0][1:]
    return np.concatenate([at + begin for begin, at, _ in found]), np.concatenate([h for _, _, h in found])


def batch_anchors(batch: list[str]) -> list[Anchors]:
    """`anchors` of many texts; short ones share one pass, windows over their seams are left out."""
    out: list[Anchors | None] = [None] * len(batch)
    group: list[int] = []

    def flush() -> None:
        if not group:
            return
        bounds = np.cumsum([0, *(len(batch[i]) for i in group)])
        at, h = _windows(_codes("".join(batch[i] for i in group)))
        first = np.searchsorted(at, bounds[:-1])
        last = np.searchsorted(at, np.maximum(bounds[1:] - WINDOW + 1, bounds[:-1]))
        for i, begin, a, b in zip(group, bounds, first, last):
            out[i] = (at[a:b] - begin, h[a:b])
        group.clear()

    size = 0
    for i, text in enumerate(batch):
        if len(text) > PIECE:
            out[i] = anchors(text)
            continue
        if size + len(text) > PIECE:
            flush()
            size = 0
        group.append(i)
        size += len(text)
    flush()
    return out  # type: ignore[return-value]


def sketch(found: Anchors, text: str) -> np.ndarray:
    """Hashes of the `ANCHORS` smallest distinct anchors by their first places."""
    at, h = found
    if len(h) == 0:
        if not text:
            return np.empty(0, np.uint64)
        return np.frombuffer(hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()[:4], ">u4").astype(np.uint64)
    if len(h) > 4 * ANCHORS:  # sort few: the distinct smallest lie below a bound with room for repeats
        bound = np.partition(h, 2 * ANCHORS)[2 * ANCHORS]
        low = np.flatnonzero(h <= bound)
        values, first = np.unique(h[low], return_index=True)
        if len(values) >= ANCHORS:
            return h[np.sort(low[first[:ANCHORS]])]
    values, first = np.unique(h, return_index=True)
    return h[np.sort(first[:ANCHORS])]


def edited_sketch(own: Anchors, text: str, following: Anchors, next_text: str) -> tuple[str, np.ndarray]:
    """The edited text and its sketch, from the anchors of both texts."""
    half = len(text) // 2
    keep = len(text) - half
    tail = min(half, len(next_text))
    edited = text[:keep] + next_text[:tail]
    head = np.searchsorted(own[0], max(keep - WINDOW + 1, 0))
    moved = np.searchsorted(following[0], max(tail - WINDOW + 1, 0))
    begin = max(keep - WINDOW + 1, 0)
    seam_at, seam = _windows(_codes(edited[begin : keep + WINDOW - 1])) if tail else (own[0][:0], own[1][:0])
    at = np.concatenate((own[0][:head], seam_at + begin, following[0][:moved] + keep))
    return edited, sketch((at, np.concatenate((own[1][:head], seam, following[1][:moved]))), edited)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    place = {h: i for i, h in enumerate(b.tolist())}
    own = a.tolist()
    union = sorted({*own, *place})[:ANCHORS]
    bound = union[-1]
    ends: list[int] = []  # smallest last place of a common order of each length
    for h in own:
        if h <= bound and (p := place.get(h)) is not None:
            i = bisect_left(ends, p)
            ends[i : i + 1] = [p]
    return len(ends) / len(union)


def written(s: np.ndarray) -> str:
    return s.astype(">u4").tobytes().hex()


class _Row:
    """A document, its anchors and its sketch."""

    def __init__(self, bucket: int, doc_id: int | None, extra: bool, text: str, found: Anchors) -> None:
        self.bucket, self.doc_id, self.extra, self.text, self.anchors = bucket, doc_id, extra, text, found
        self.sketch = sketch(found, text)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket and order; the last of a bucket is the first of the next, marked extra."""
    last: _Row | None = None
    for whole in batches:
        for batch in pieces(whole, "text", 2 << 20):
            rows = strings(batch.column("text"))
            out: list[tuple] = []
            for bucket, doc_id, extra, text, found in zip(
                batch.column("bucket").to_pylist(), batch.column("doc_id").to_pylist(),
                batch.column("extra").to_pylist(), rows, batch_anchors(rows),
            ):
                row = _Row(bucket, doc_id, extra, text, found)
                if last is not None and last.bucket == bucket:
                    edited, mark = edited_sketch(last.anchors, last.text, found, text)
                    out.append((
                        last.doc_id, len(last.text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                        written(last.sketch), written(mark), likeness(last.sketch, mark), likeness(last.sketch, row.sketch),
                    ))
                last = row
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            columns = list(zip(*out)) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _NAMES)


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _range_of(column: str, cuts: list[int]) -> Column:
    """The number of cut points below a value, by binary search; 0 for null."""
    width = 1
    while width <= len(cuts):
        width *= 2
    padded = F.lit([*cuts, *[2**63 - 1] * (2 * width - 1 - len(cuts))])
    steps = F.lit([width >> i for i in range(width.bit_length())])

    def step(low: Column, by: Column) -> Column:
        return F.when(F.element_at(padded, low + by) < F.col(column), low + by).otherwise(low)

    return F.aggregate(steps, F.lit(0), step)


def fingerprints(docs: DataFrame) -> DataFrame:
    """The fingerprint of each document, of its edited text, and their likeness.

    The table is cut into ranges of ids with about as many rows each; a range
    also gets the first document of the next one, so one shuffle brings every
    document beside its successor. Rows of one id stay in one range.
    """
    spark = docs.sparkSession
    t = texts(docs)
    n = 16 * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = t.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100 * n)).first()[0] or []
    cuts = sorted(set(cuts))
    placed = t.withColumn("bucket", _range_of("doc_id", cuts))
    # One row for each range, at most n.
    heads = sorted((r[0], r[1]) for r in placed.groupBy("bucket").agg(F.min(F.struct(
        F.col("doc_id").isNotNull().alias("set"), "doc_id")).alias("low")).select("bucket", "low.doc_id").collect())
    if not heads:
        return spark.createDataFrame([], _SCHEMA)
    before = {b: (heads[i - 1][0], low) for i, (b, low) in enumerate(heads)}
    firsts = spark.createDataFrame([(b, p, low) for b, (p, low) in before.items()], "bucket int, previous int, low long")
    # Of equal first ids the smallest text comes first; only rows of that id travel twice.
    first_rows = (
        placed.join(F.broadcast(firsts), "bucket").where(F.col("doc_id").eqNullSafe(F.col("low")))
        .groupBy("previous", "doc_id").agg(F.min("text").alias("text"))
        .select("doc_id", "text", F.col("previous").alias("bucket"), F.lit(True).alias("extra"))
    )
    both = placed.withColumn("extra", F.lit(False)).unionByName(first_rows)
    return (
        both.repartition(n // 16, "bucket").sortWithinPartitions("bucket", "extra", F.col("doc_id").asc_nulls_first(), "text")
        .mapInArrow(_compare, _SCHEMA)
    )
