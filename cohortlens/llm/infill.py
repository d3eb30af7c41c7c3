"""Fill-in-middle transformation of documents by a piece table.

A text is an immutable buffer of UTF-8 bytes, the sentinels are another. A
document is a list of descriptors (buffer, begin, end) over them: cutting splits
a descriptor, an arrangement permutes descriptors and puts sentinels between
them, and a hash runs over the descriptors one by one. The inverse permutation
of the pieces that a written form is cut into at its sentinels gives back the
text.

A unit is a token with the white space before it; white space at the end is a
unit of its own. Two places among the units, drawn from a hash of seed and
`doc_id`, bound the middle. A text stays plain by the same hash, if it is empty
or if it has a sentinel in it already; else the form is spm or psm. No sentinel
begins with the end of one, so in a written form each is found at its place
alone.

Null texts count as empty (plain, no units). A null `doc_id` is drawn as `null`.
Equal ids share their draws; repeated rows give the same row each. Texts of any
length are taken whole, one at a time. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .texts import SPACE, bytes_of, pieces, strings, texts, word_spans

SEED = 42
CHANGED = 50  # percent of the texts that are rearranged
SPM = 80  # percent of those that put the suffix first
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
# Sentinels (capitals) and pieces p, m, s of the text in written order.
FORMS = {"psm": "PpSsMm", "spm": "SsPpMm"}


class Piece(NamedTuple):
    """A descriptor: a stretch of one of the buffers."""

    buffer: int
    begin: int
    end: int


class PieceTable:
    """Descriptors in order over buffers that never change."""

    def __init__(self, buffers: Sequence[bytes], table: Sequence[Piece]) -> None:
        self.buffers, self.table = buffers, list(table)

    @classmethod
    def of(cls, *buffers: bytes) -> PieceTable:
        """A table with the first buffer as its only piece."""
        return cls(buffers, [Piece(0, 0, len(buffers[0]))])

    def cut(self, *places: int) -> PieceTable:
        """Split the only descriptor at rising places."""
        (buffer, begin, end), = self.table
        bounds = [begin, *places, end]
        return PieceTable(self.buffers, [Piece(buffer, a, b) for a, b in zip(bounds[:-1], bounds[1:])])

    def arranged(self, order: Sequence[int]) -> PieceTable:
        """The descriptors with the given numbers, in that order."""
        return PieceTable(self.buffers, [self.table[i] for i in order])

    def with_pieces(self, *more: Piece) -> PieceTable:
        return PieceTable(self.buffers, [*self.table, *more])

    def stream(self) -> Iterator[memoryview]:
        views = [memoryview(b) for b in self.buffers]
        return (views[p.buffer][p.begin : p.end] for p in self.table)

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for view in self.stream():
            digest.update(view)
        return digest.hexdigest()

    def content(self) -> bytes:
        return b"".join(self.stream())


_SENTINELS = PREFIX + SUFFIX + MIDDLE
_PLACE = {"P": Piece(1, 0, 3), "S": Piece(1, 3, 6), "M": Piece(1, 6, 9)}


def inverse(order: Sequence[int]) -> list[int]:
    back = [0] * len(order)
    for i, j in enumerate(order):
        back[j] = i
    return back


def arrange(text: bytes, first: int, last: int, form: str) -> PieceTable:
    """The written form of a text whose middle lies between two places."""
    table = PieceTable.of(text, _SENTINELS).cut(first, last).with_pieces(*_PLACE.values())
    number = {c: i for i, c in enumerate(["p", "m", "s", *_PLACE])}
    return table.arranged([number[c] for c in FORMS[form]])


def restore(written: bytes, form: str) -> PieceTable:
    """The text of a written form: its pieces between the sentinels in their old order."""
    table = PieceTable.of(written)
    if form == "plain":
        return table
    sentinel = {"P": PREFIX, "S": SUFFIX, "M": MIDDLE}
    places, at = [], 0
    for c in FORMS[form][::2]:
        found = written.find(sentinel[c], at)
        if found < 0:
            raise ValueError(f"no {sentinel[c].decode()} in a text of form {form}")
        at = found + len(sentinel[c])
        places += [found, at]
    # Before the first sentinel there is nothing; then sentinel, piece, sentinel, piece, ...
    parts = table.cut(*places).arranged([2, 4, 6])
    order = ["pms".index(c) for c in FORMS[form][1::2]]
    return parts.arranged(inverse(order))


class Plan(NamedTuple):
    n: int
    form: str
    first: int
    last: int


def _draws(seed: int, doc_id: int | None) -> list[int]:
    name = "null" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"{seed}:{name}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def plans(batch: pa.RecordBatch, seed: int = SEED, changed: int = CHANGED, spm: int = SPM) -> Iterator[tuple[bytes, Plan]]:
    """The bytes of each text of a batch and how it is to be arranged."""
    raw, at = bytes_of(batch.column("text"))
    ends = word_spans(raw, at)[1]
    words = np.searchsorted(ends, at, "right")
    for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
        begin, end = int(at[i]), int(at[i + 1])
        text = raw[begin:end].tobytes()
        own = ends[words[i] : words[i + 1]]
        n = len(own) + int(end > begin and SPACE[raw[end - 1]])
        draw = _draws(seed, doc_id)
        if n == 0 or draw[2] % 100 >= changed or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
            yield text, Plan(n, "plain", 0, 0)
            continue
        units = sorted((draw[0] % (n + 1), draw[1] % (n + 1)))
        places = [0 if u == 0 else int(own[u - 1]) - begin if u <= len(own) else end - begin for u in units]
        yield text, Plan(n, "spm" if draw[3] % 100 < spm else "psm", *places)


def _chars(text: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def _lengths(text: bytes, plan: Plan) -> tuple[int | None, int | None]:
    if plan.form == "plain":
        return None, None
    return _chars(text[: plan.first]), _chars(text[plan.first : plan.last])


def _written(text: bytes, plan: Plan) -> PieceTable:
    return PieceTable.of(text) if plan.form == "plain" else arrange(text, plan.first, plan.last, plan.form)


def _columns(rows: list[tuple], names: Sequence[str], kinds: Sequence[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], list(names))


def transform(docs: DataFrame, seed: int = SEED, changed: int = CHANGED, spm: int = SPM) -> DataFrame:
    """`doc_id`, `n` units, `form`, `prefix_chars`, `middle_chars` (null if plain) and the written `output`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text", 1 << 20):
                ids = batch.column("doc_id").to_pylist()
                rows = [
                    (i, plan.n, plan.form, *_lengths(text, plan), _written(text, plan).content().decode())
                    for i, (text, plan) in zip(ids, plans(batch, seed, changed, spm))
                ]
                yield _columns(
                    rows, ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output"),
                    (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()),
                )

    return texts(docs).mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(written: DataFrame) -> DataFrame:
    """`doc_id` and `text` from `doc_id`, `form` and `output`; a null output stands for an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "output", 1 << 20):
                rows = [
                    (i, restore(output.encode(), form or "plain").content().decode())
                    for i, form, output in zip(
                        batch.column("doc_id").to_pylist(), batch.column("form").to_pylist(), strings(batch.column("output"))
                    )
                ]
                yield _columns(rows, ("doc_id", "text"), (pa.int64(), pa.string()))

    return written.select("doc_id", "form", "output").mapInArrow(run, "doc_id long, text string")


_NAMES = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def digests(docs: DataFrame) -> DataFrame:
    """What `transform` gives with digests for the texts: of the output and of the text restored from it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text", 1 << 20):
                rows = []
                for i, (text, plan) in zip(batch.column("doc_id").to_pylist(), plans(batch)):
                    table = _written(text, plan)
                    back = restore(table.content(), plan.form)
                    rows.append((i, plan.n, plan.form, *_lengths(text, plan), table.sha256(), back.sha256()))
                yield _columns(
                    rows, _NAMES,
                    (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()),
                )

    return texts(docs).mapInArrow(
        run,
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string",
    )


_H = "('0x' || substr(h, {at}, 8))::BIGINT"
_SPACE = "[\\x20\\x09-\\x0D]"
_OTHER = "[^\\x20\\x09-\\x0D]"

ORACLE = f"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h,
    regexp_extract_all(coalesce(text, ''), '{_SPACE}*{_OTHER}+|{_SPACE}+') AS units
  FROM documents
), drawn AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, {_H.format(at=1)} % (len(units) + 1) AS u1, {_H.format(at=9)} % (len(units) + 1) AS u2,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR {_H.format(at=17)} % 100 >= {CHANGED} THEN 'plain' WHEN {_H.format(at=25)} % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form
  FROM cut
), parts AS (
  SELECT *, array_to_string(units[1:least(u1, u2)], '') AS p,
    array_to_string(units[least(u1, u2) + 1:greatest(u1, u2)], '') AS m,
    array_to_string(units[greatest(u1, u2) + 1:], '') AS s
  FROM drawn
), written AS (
  SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS output
  FROM parts
), found AS (
  SELECT *, strpos(output, '<P>') AS ip, strpos(output, '<S>') AS js, strpos(output, '<M>') AS im FROM written
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(output) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN output
    WHEN 'psm' THEN output[4:js - 1] || output[im + 3:] || output[js + 3:im - 1]
    ELSE output[ip + 3:im - 1] || output[im + 3:] || output[4:ip - 1] END) AS restored_sha256
FROM found
"""
