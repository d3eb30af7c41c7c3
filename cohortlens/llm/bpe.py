"""Encoding and decoding with a public word BPE vocabulary, by a pair occurrence index.

The distinct new words of a piece of a partition are laid out as one long row of
symbols, and every adjacent pair that has a merge rank is listed with all its
places. The active ranks are then applied in ascending order, each to all its
places at once; a merge enters the pairs it creates into the lists of their
ranks. A merge can only create pairs whose rank is read from the same table, so
every word gets the merges it would get alone, in the same order.

Normalisation (NFC, lower case), the split into words and the special tokens
follow the vocabulary file. Null texts count as empty: no ids, empty decoded
text. The vocabulary is read from the path given, on the driver, and sent to the
executors; its size is that of the file (about 2 MB).
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sharing import receive, send
from .texts import frugal, pieces, strings, texts

# Words whose ids a worker remembers; beyond it starts afresh.
REMEMBERED = 100_000
_SPACES = r"\t-\r \x85\xa0  -     　"


def _byte_letters() -> list[str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Vocabulary:
    """Symbols, merges and special tokens of a tokenizers file with word ends."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"]
        self.words = regex.compile(
            spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"[^\s", f"[^{_SPACES}")
        )
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = [""] * (max([*ids.values(), *self.special.values()]) + 1)
        for table in (ids, self.special):
            for token, i in table.items():
                self.token[i] = token
        letters = _byte_letters()
        self.inner = np.array([ids[c] for c in letters], np.int64)
        self.final = np.array([ids[c + end] for c in letters], np.int64)
        pairs = [(ids[a], ids[b], ids[a + b]) for a, b in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])]
        self.left, self.right, self.merged = np.array(pairs, np.int64).T
        codes = self.left << 20 | self.right
        self.by_code = np.argsort(codes, kind="stable")
        self.codes = codes[self.by_code]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 if it has none."""
        code = a << 20 | b
        place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where((self.codes[place] == code) & (a >= 0) & (b >= 0), self.by_code[place], -1)

    def split(self, text: str) -> list[str]:
        """Words in order; a special token stands as itself."""
        found = [""]
        if any(t in text for t in self.special):
            found = regex.split("(" + "|".join(map(regex.escape, self.special)) + ")", text)
        else:
            found = [text]
        out: list[str] = []
        for part in found:
            if part in self.special:
                out.append(part)
            elif part:
                part = unicodedata.normalize("NFC", part)
                # Lower case letter by letter: a final sigma is no special case.
                out += self.words.findall(part.replace("Σ", "σ").lower())
        return out

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in order, and the n + 1 places where those of each word begin."""
        raw = [w.encode("utf-8") for w in words]
        sizes = np.array([len(r) for r in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        # Words lie one after the other, each followed by a gap of -1.
        begin = np.concatenate(([0], np.cumsum(sizes + 1)))
        owner = np.repeat(np.arange(len(raw)), sizes)
        symbol = np.full(begin[-1], -1, np.int64)
        symbol[np.arange(len(flat)) + owner] = self.inner[flat]
        last = begin[1:] - 2
        symbol[last] = self.final[flat[np.cumsum(sizes) - 1]]
        after = np.arange(1, len(symbol) + 1)
        before = np.arange(-1, len(symbol) - 1)
        self._merge(symbol, before, after)
        alive = symbol >= 0
        return symbol[alive], np.concatenate(([0], np.cumsum(alive)))[begin]

    def _merge(self, symbol: np.ndarray, before: np.ndarray, after: np.ndarray) -> None:
        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray, rank: np.ndarray) -> None:
            good = rank >= 0
            if not good.any():
                return
            at, rank = at[good], rank[good]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cut = [0, *(np.flatnonzero(rank[1:] != rank[:-1]) + 1).tolist()]
            for r, first, last in zip(rank[cut].tolist(), cut, [*cut[1:], len(at)]):
                if r in places:
                    places[r].append(at[first:last])
                else:
                    places[r] = [at[first:last]]
                    heapq.heappush(active, r)

        enter(np.arange(len(symbol) - 1), self.ranks(symbol[:-1], symbol[1:]))
        limit = len(symbol) - 1
        while active:
            r = heapq.heappop(active)
            spots = places.pop(r)
            # A place is listed once per rank: what it holds only grows, so a pair does not come back.
            at = np.sort(spots[0] if len(spots) == 1 else np.concatenate(spots))
            a, b, new = self.left[r], self.right[r], self.merged[r]
            nxt = after[at]
            # Places that earlier merges have changed no longer hold the pair.
            valid = (symbol[at] == a) & (symbol[np.minimum(nxt, limit)] == b)
            at, nxt = at[valid], nxt[valid]
            if a == b and len(at) > 1:
                at = self._apart(at, nxt)
                nxt = after[at]
            if not len(at):
                continue
            symbol[at] = new
            symbol[nxt] = -2
            beyond = after[nxt]
            after[at] = beyond
            inside = beyond <= limit
            before[beyond[inside]] = at[inside]
            left = before[at]
            other = left >= 0
            other[1:] &= left[1:] != at[:-1]
            starts = np.concatenate((left[other], at))
            right = np.minimum(after[starts], limit)
            enter(starts, self.ranks(symbol[starts], symbol[right]))

    @staticmethod
    def _apart(at: np.ndarray, nxt: np.ndarray) -> np.ndarray:
        """Of overlapping places of a doubled symbol, those taken from left to right."""
        taken, blocked = [], -1
        for p, q in zip(at.tolist(), nxt.tolist()):
            if p != blocked:
                taken.append(p)
                blocked = q
        return np.array(taken, np.int64)


class Encoder:
    """Ids and decoded tokens of texts; remembers words."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.ids: dict[str, bytes] = {}
        self.shown: dict[str, str] = {}
        self._forget()

    def _forget(self) -> None:
        self.ids = {t: np.uint32(i).tobytes() for t, i in self.vocabulary.special.items()}
        self.shown = {t: t for t in self.vocabulary.special}

    def learn(self, words: set[str]) -> None:
        new = list(words - self.ids.keys())
        if not new:
            return
        if len(self.ids) + len(new) > REMEMBERED:
            # The words at hand stay.
            again = words & self.ids.keys()
            ids, shown = self.ids, self.shown
            self._forget()
            self.ids.update((w, ids[w]) for w in again)
            self.shown.update((w, shown[w]) for w in again)
        found, at = self.vocabulary.encode_words(new)
        raw, at = found.astype("<u4").tobytes(), at.tolist()
        tokens = list(map(self.vocabulary.token.__getitem__, found.tolist()))
        self.ids.update((w, raw[4 * a : 4 * b]) for w, a, b in zip(new, at, at[1:]))
        self.shown.update((w, " ".join(tokens[a:b])) for w, a, b in zip(new, at, at[1:]))

    def encode(self, batch: list[str]) -> Iterator[tuple[bytes, str]]:
        """Per text: ids as little-endian 32-bit numbers, and the decoded text."""
        split = [self.vocabulary.split(t) for t in batch]
        self.learn(set().union(*split))
        ids, shown = self.ids.__getitem__, self.shown.__getitem__
        for words in split:
            yield b"".join(map(ids, words)), " ".join(map(shown, words))


def _digests(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(receive(vocabulary))
        for whole in batches:
            for batch in pieces(whole, "text", 2 << 20):
                rows = [
                    (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(shown.encode()).hexdigest())
                    for ids, shown in encoder.encode(strings(batch.column("text")))
                ]
                n, ids, shown = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids), pa.array(shown)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
    return run


def _tokens(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(receive(vocabulary))
        for whole in batches:
            for batch in pieces(whole, "text", 2 << 20):
                found = list(encoder.encode(strings(batch.column("text"))))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array([np.frombuffer(i, "<u4").astype(np.int32) for i, _ in found], pa.list_(pa.int32())),
                        pa.array([d for _, d in found], pa.string()),
                    ],
                    ["doc_id", "ids", "decoded"],
                )
    return run


def encode(docs: DataFrame, path: str) -> DataFrame:
    """`doc_id`, `ids` and `decoded` text of every document."""
    shared = send(docs.sparkSession, Vocabulary(path))
    return texts(docs).mapInArrow(frugal(_tokens(shared)), "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """`doc_id`, `n_tokens` and SHA-256 digests of the ids and of the decoded text."""
    shared = send(docs.sparkSession, Vocabulary(path))
    return texts(docs).mapInArrow(
        frugal(_digests(shared)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
