"""Toxicity by a support vector machine on a subsequence string kernel.

The kernel of two strings sums over common subsequences of `ORDER` letters,
each weighted by `DECAY` to the power of the letters it spans, so gaps and
inserted letters cost a factor but do not break a match. Strings are letter
windows of at most `WIDTH` letters of a word, without accents and without
anything that is no letter ("i.d.i.o.t" is "idiot"); runs of single letters are
joined as well. `LANDMARKS` strings, chosen from labelled training texts, give
the Nystrom map: the normalised kernel to every landmark, to the power `POWER`
(again a kernel), times the inverse root of the landmarks' own matrix. A
sentence is the maximum over its words, a document the maximum over its
sentences.

Only documents are labelled, so training picks, in turns, the worst sentence of
each toxic document as its example (all sentences of the clean ones are
counter-examples). It uses at most `TRAIN_EACH` documents of each label, chosen
by a hash of the id; the model is learnt on the driver from a few numbers per
sentence. Scores are the fitted logistic of the decision value.

Null and empty texts are scored like a sentence without a match. Without
training rows of both labels the score is their share of toxic ones (0 if none).
Inputs of a score are the text alone; repeated rows are scored alike.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sharing import receive, send
from .texts import frugal, kept, pieces, strings, texts

ORDER = 3
DECAY = 0.6
WIDTH = 8
STRIDE = 2
POWER = 3
LANDMARKS = 32
GRAMS = (4, 5, 6, 8)
# Labelled training documents of each label, and sentences of each.
TRAIN_EACH = 3000
TRAIN_SENTENCES = 6
# Words whose kernel rows a task remembers (128 bytes each, and the word), and bytes of text it reads at a time.
REMEMBERED = 100_000
PIECE = 1 << 20
_BITS = 5  # of a letter's number
_LETTERS = 1 << _BITS
_TRIPLES = [c for n in range(ORDER, WIDTH + 1) for c in combinations(range(n), ORDER) if c[-1] == n - 1]
_COUNT = [sum(c[-1] < n for c in _TRIPLES) for n in range(WIDTH + 1)]
_PLACES = np.array(_TRIPLES).T
_WEIGHT = DECAY ** (_PLACES[-1] - _PLACES[0] + 1).astype(np.float32)
_NO_LETTER = regex.compile(r"\P{L}+")
_NO_LETTER_IN_LINE = regex.compile(r"[^\p{L}\n]+")
_END = regex.compile(r"[.!?]\P{L}*$")


def letters(word: str) -> str:
    """Letters of a word, lower case, without accents."""
    if word.isascii() and word.isalpha():
        return word.lower()
    return _NO_LETTER.sub("", unicodedata.normalize("NFKD", word.lower()))


def letters_of(words: list[str]) -> list[str]:
    """`letters` of words in lower case that hold no line feed, all at once."""
    return _NO_LETTER_IN_LINE.sub("", unicodedata.normalize("NFKD", "\n".join(words))).split("\n") if words else []


def windows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the words as packed numbers, in order, and the place of each one's word."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int32)
    small = (flat >= 97) & (flat <= 122)
    # Letters as numbers 1 to 31; 0 beyond the end of a word.
    code = np.concatenate((np.where(small, flat - 96, 27 + flat % 5), np.zeros(WIDTH, np.int32)))
    size = np.fromiter(map(len, words), np.int64, len(words))
    count = np.maximum(size - WIDTH + STRIDE - 1, 0) // STRIDE + 1
    owner = np.repeat(np.arange(len(words)), count)
    turn = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    size, begin = size[owner], (np.cumsum(size) - size)[owner]
    start = np.minimum(turn * STRIDE, np.maximum(size - WIDTH, 0))
    packed = np.zeros(len(owner), np.int64)
    for j in range(WIDTH):
        packed = packed << _BITS | np.where(start + j < size, code[np.minimum(begin + start + j, len(flat))], 0)
    return packed, owner


def _columns(packed: np.ndarray) -> list[np.ndarray]:
    """The letters of windows, a row for each place in the window."""
    return [(packed >> _BITS * (WIDTH - 1 - j) & _LETTERS - 1).astype(np.int32) for j in range(WIDTH)]


def features(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per window: the codes of its subsequences, their weights, and its kernel with itself."""
    codes = np.stack(_columns(packed), axis=1)
    a, b, c = (codes[:, p] for p in _PLACES)
    subsequence = (a * _LETTERS + b) * _LETTERS + c
    weight = np.where(c > 0, _WEIGHT, np.float32(0))
    # One sort of numbers that also hold the places, 56 at most.
    by = np.sort(subsequence << 6 | np.arange(len(_TRIPLES), dtype=np.int32), axis=1)
    by, place = by >> 6, by & 63
    total = np.cumsum(np.where(by % _LETTERS > 0, _WEIGHT[place], np.float32(0)), axis=1, dtype=np.float64)
    # The sum of each run of equal subsequences, squared.
    last = np.ones(by.shape, bool)
    last[:, :-1] = by[:, 1:] != by[:, :-1]
    ends = np.where(last, total, 0.0)
    before = np.maximum.accumulate(ends, axis=1)
    before = np.concatenate((np.zeros((len(by), 1)), before[:, :-1]), axis=1)
    own = (np.where(last, total - before, 0.0) ** 2).sum(axis=1)
    return subsequence, weight, own


class Kernel:
    """Similarity of strings to a list of landmarks."""

    def __init__(self, landmarks: list[str]) -> None:
        self.landmarks = landmarks
        subsequence, weight, own = features(windows(landmarks)[0])
        self.table = np.zeros((_LETTERS**ORDER, len(landmarks)), np.float32)
        for i in range(len(landmarks)):
            np.add.at(self.table[:, i], subsequence[i], weight[i] / np.sqrt(max(own[i], 1e-12)))
        self.table[0] = 0
        self.known = self.table.any(axis=1)

    def __call__(self, strings_: list[str]) -> np.ndarray:
        """A row for each string of at most `WIDTH` letters."""
        return self.of(windows(strings_)[0])

    def of(self, packed: np.ndarray) -> np.ndarray:
        """A row for each window."""
        out = np.zeros((len(packed), len(self.landmarks)), np.float32)
        for first in range(0, len(packed), 4096):
            part = packed[first : first + 4096]
            letter = _columns(part)
            shared = np.stack([self.known[(letter[a] << _BITS | letter[b]) << _BITS | letter[c]] for a, b, c in _TRIPLES], axis=1)
            rows = np.flatnonzero(shared.any(axis=1))
            if not len(rows):
                continue
            subsequence, weight, own = features(part[rows])
            scale = (weight / np.sqrt(np.maximum(own, 1e-12))[:, None]).astype(np.float32)
            # Of the subsequences of a window few are in a landmark; only they count.
            row, j = np.nonzero(shared[rows])
            each = self.table[subsequence[row, j]] * scale[row, j][:, None]
            total = np.add.reduceat(each, np.flatnonzero(np.diff(row, prepend=-1)), axis=0)
            out[first + rows] = np.minimum(total, 1.0) ** POWER
        return out


class Reader:
    """Kernel rows of the sentences of texts; remembers words."""

    def __init__(self, kernel: Kernel) -> None:
        self.kernel = kernel
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        # Per word: its kernel row, whether it is one letter, whether it ends a sentence.
        self.row, self.single, self.ends = np.zeros(4096, np.int32), np.zeros(4096, bool), np.zeros(4096, bool)
        self.used = 1  # row 0 is that of words without a match
        self.rows = np.zeros((4096, len(self.kernel.landmarks)), np.float32)

    def _keep(self, words: set[str]) -> None:
        """Forget all but these words."""
        again = list(words & self.place.keys())
        place = np.fromiter(map(self.place.__getitem__, again), np.int64, len(again))
        single, ends, rows = self.single[place], self.ends[place], self.rows[self.row[place]]
        self._forget()
        self._grow(("row", "single", "ends"), len(again))
        self._grow(("rows",), 1 + len(again))
        self.place.update(zip(again, range(len(again))))
        self.row[: len(again)] = np.arange(1, 1 + len(again))
        self.single[: len(again)], self.ends[: len(again)] = single, ends
        self.rows[1 : 1 + len(again)] = rows
        self.used = 1 + len(again)

    def _grow(self, names: tuple[str, ...], size: int) -> None:
        """Room for so many entries; arrays at least double."""
        for name in names:
            old = getattr(self, name)
            if size > len(old):
                new = np.zeros((max(size, 2 * len(old)), *old.shape[1:]), old.dtype)
                new[: len(old)] = old
                setattr(self, name, new)

    def _learn(self, words: set[str]) -> None:
        new = list(words - self.place.keys())
        if not new:
            return
        if len(self.place) + len(new) > REMEMBERED and self.place:
            self._keep(words)
        plain = letters_of(new)
        packed, owner = windows(plain)
        packed, at = np.unique(packed, return_inverse=True)
        found = self.kernel.of(packed)
        hit = np.flatnonzero(found.any(axis=1)[at])
        base, end = len(self.place), len(self.place) + len(new)
        self._grow(("row", "single", "ends"), end)
        if len(hit):
            first = np.flatnonzero(np.diff(owner[hit], prepend=-1))
            self._grow(("rows",), self.used + len(first))
            self.rows[self.used : self.used + len(first)] = np.maximum.reduceat(found[at[hit]], first, axis=0)
            self.row[base + owner[hit[first]]] = np.arange(self.used, self.used + len(first))
            self.used += len(first)
        self.place.update(zip(new, range(base, end)))
        self.single[base:end] = [len(p) == 1 for p in plain]
        self.ends[base:end] = [not w.isalpha() and _END.search(w) is not None for w in new]

    def sentences(self, batch: list[str]) -> Iterator[np.ndarray]:
        """Per text, one kernel row for each sentence; at least one."""
        split = [t.lower().split() for t in batch]
        self._learn(set().union(*split))
        single, ends = self.single, self.ends
        for words in split:
            if not words:
                yield np.zeros((1, self.rows.shape[1]), np.float32)
                continue
            place = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
            starts = np.concatenate(([0], np.flatnonzero(ends[place[:-1]]) + 1))
            rows = np.zeros((len(starts), self.rows.shape[1]), np.float32)
            row = self.row[place]
            if len(hit := np.flatnonzero(row)):
                sentence = np.searchsorted(starts, hit, "right") - 1
                first = np.flatnonzero(np.diff(sentence, prepend=-1))
                rows[sentence[first]] = np.maximum.reduceat(self.rows[row[hit]], first, axis=0)
            alone = single[place]
            if alone.any():
                rows = self._spelled(words, alone, starts, rows)
            yield rows

    def _spelled(self, words: list[str], alone: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Also read runs of four or more single letters as one word."""
        edge = np.flatnonzero(np.diff(np.concatenate(([0], alone.view(np.int8), [0]))))
        for a, b in zip(edge[::2], edge[1::2]):
            if b - a >= 4:
                packed, _ = windows(["".join(letters(w) for w in words[a:b])])
                i = np.searchsorted(starts, a, "right") - 1
                rows[i] = np.maximum(rows[i], self.kernel.of(packed).max(axis=0))
        return rows


class Model:
    """Landmarks, weights of the decision value, and its logistic."""

    def __init__(self, kernel: Kernel | None, weights: np.ndarray, bias: float, slope: float, shift: float, prior: float) -> None:
        self.kernel, self.weights, self.bias = kernel, weights, bias
        self.slope, self.shift, self.prior = slope, shift, prior

    def scores(self, reader: Reader, batch: list[str]) -> list[float]:
        value = np.array([(rows @ self.weights).max() for rows in reader.sentences(batch)], np.float64) + self.bias
        return (1 / (1 + np.exp(-np.clip(self.slope * value + self.shift, -60, 60)))).tolist()


def _learn_svm(rows: np.ndarray, sign: np.ndarray, cost: np.ndarray, rounds: int = 600) -> tuple[np.ndarray, float]:
    """Linear SVM by averaged subgradient steps; `cost` weighs the examples."""
    x = np.concatenate((rows, np.ones((len(rows), 1))), axis=1)
    w = np.zeros(x.shape[1])
    mean, total = np.zeros_like(w), 0.0
    penalty = np.full(len(w), 1e-3)
    penalty[-1] = 0
    for t in range(1, rounds + 1):
        wrong = sign * (x @ w) < 1
        step = 4.0 / (1 + 0.02 * t)
        w = w - step * (penalty * w - ((cost * sign)[wrong, None] * x[wrong]).sum(axis=0))
        mean, total = mean + t * w, total + t
    mean = mean / total
    return mean[:-1], float(mean[-1])


def _fit_logistic(value: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    slope, shift = 1.0, 0.0
    # Smoothed targets keep separable data from an infinite slope.
    good, bad = label.sum(), (1 - label).sum()
    target = np.where(label > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(slope * value + shift, -60, 60)))
        g = np.array([((p - target) * value).sum(), (p - target).sum()])
        q = p * (1 - p) + 1e-9
        h = np.array([[(q * value * value).sum(), (q * value).sum()], [(q * value).sum(), q.sum()]]) + 1e-6 * np.eye(2)
        slope, shift = np.array([slope, shift]) - np.linalg.solve(h, g)
    return float(slope), float(shift)


def learn(documents: list[int], rows: np.ndarray, toxic: dict[int, int], kernel: Kernel) -> Model:
    """Fit the decision on sentence rows; `documents` tells whose each row is."""
    own = np.asarray(documents)
    label = np.array([toxic[d] for d in own.tolist()])
    z = kernel(kernel.landmarks).astype(np.float64)
    value, vector = np.linalg.eigh((z + z.T) / 2)
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-2))) @ vector.T
    mapped = rows.astype(np.float64) @ root
    names, first = np.unique(own, return_inverse=True)
    strength = rows.max(axis=1).astype(np.float64)
    weights, bias = np.zeros(mapped.shape[1]), 0.0
    for _ in range(4):
        order = np.lexsort((strength, first))
        worst = order[np.flatnonzero(np.append(np.diff(first[order]) != 0, True))]
        use = np.concatenate((worst[label[worst] == 1], np.flatnonzero(label == 0)))
        sign = np.where(label[use] == 1, 1.0, -1.0)
        cost = np.where(sign > 0, 0.5 / max(1, (sign > 0).sum()), 0.5 / max(1, (sign < 0).sum()))
        weights, bias = _learn_svm(mapped[use], sign, cost)
        strength = mapped @ weights + bias
    best = np.full(len(names), -np.inf)
    np.maximum.at(best, first, strength)
    truth = np.array([toxic[d] for d in names.tolist()], float)
    slope, shift = _fit_logistic(best, truth)
    return Model(kernel, (root @ weights).astype(np.float32), bias, slope, shift, truth.mean())


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of each label hold a letter sequence; counted here, summed by Spark."""
    counts = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(strings(batch.column("text")), batch.column("toxic").to_pylist()):
            found: set[str] = set()
            for word in {letters(w) for w in set(text.split())}:
                if len(word) >= GRAMS[0]:
                    found.add(word[:WIDTH])
                    found.update(word[i : i + n] for n in GRAMS for i in range(len(word) - n + 1))
            counts[toxic].update(found)
            if len(counts[0]) + len(counts[1]) > 200_000:
                yield from _counted(counts)
    yield from _counted(counts)


def _counted(counts: tuple[Counter, Counter]) -> Iterator[pa.RecordBatch]:
    for toxic, counter in enumerate(counts):
        if counter:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counter), pa.string()), pa.array([toxic] * len(counter), pa.int32()), pa.array(list(counter.values()), pa.int64())],
                ["gram", "toxic", "n"],
            )
        counter.clear()


def _train_rows(model_kernel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(receive(model_kernel))
        for whole in batches:
            for batch in pieces(whole, "text", PIECE):
                ids, rows = [], []
                for doc_id, found in zip(batch.column("doc_id").to_pylist(), reader.sentences(strings(batch.column("text")))):
                    best = np.argsort(-found.max(axis=1), kind="stable")[:TRAIN_SENTENCES]
                    ids += [doc_id] * len(best)
                    rows += [found[i].tobytes() for i in best]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, pa.binary())], ["doc_id", "row"])
    return run


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id`, `text`, `toxic` of the documents to learn from: at most `TRAIN_EACH` of either label."""
    usable = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
    chosen = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    few = kept(
        chosen.where("toxic = 1").orderBy(*order).limit(TRAIN_EACH)
        .unionByName(chosen.where("toxic = 0").orderBy(*order).limit(TRAIN_EACH)),
    )
    # Two numbers for each of at most 2 x TRAIN_EACH documents.
    return kept(texts(docs).join(F.broadcast(few), "doc_id").dropDuplicates(["doc_id"]))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def choose_landmarks(train: DataFrame, good: int, bad: int) -> list[str]:
    """Letter sequences that mark toxic documents best, no two of them much alike."""
    counted = train.select("text", "toxic").mapInArrow(frugal(_grams), "gram string, toxic int, n long")
    # A sequence must be in toxic documents several times as often as in clean ones.
    most = max(2.0, 0.002 * bad)
    ranked = (
        counted.groupBy("gram").agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
            F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"),
        )
        .where(F.col("bad") >= most)
        .withColumn("gain", F.col("bad") / bad - 8 * F.col("good") / good)
        .where("gain > 0").orderBy(F.desc("gain"), F.desc(F.length("gram")), "gram").limit(400).collect()
    )
    names = [r["gram"] for r in ranked]
    if not names:
        return []
    alike = Kernel(names)(names) ** (1 / POWER)
    gain = np.array([r["gain"] for r in ranked])
    # Of sequences of about the same count and the same letters the longest speaks for all.
    order = sorted(range(len(names)), key=lambda i: (-round(float(gain[i]), 2), -len(names[i]), names[i]))
    taken: list[int] = []
    for i in order:
        if len(taken) < LANDMARKS and all(
            alike[i, j] < 0.75 and names[i] not in names[j] and names[j] not in names[i] for j in taken
        ):
            taken.append(i)
    return [names[i] for i in taken]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled documents that are not held out."""
    train = training_sample(docs, labels)
    toxic = {r[0]: r[1] for r in train.select("doc_id", "toxic").collect()}  # at most 2 x TRAIN_EACH
    bad = sum(toxic.values())
    good = len(toxic) - bad
    prior = bad / len(toxic) if toxic else 0.0
    none = Model(None, np.zeros(0), 0.0, 0.0, 0.0, prior)
    if not bad or not good:
        return none
    names = choose_landmarks(train, good, bad)
    if not names:
        return none
    kernel = Kernel(names)
    shared = send(docs.sparkSession, kernel)
    rows = train.select("doc_id", "text").mapInArrow(frugal(_train_rows(shared)), "doc_id long, row binary").collect()
    rows = sorted((r[0], bytes(r[1])) for r in rows)
    matrix = np.stack([np.frombuffer(r, np.float32) for _, r in rows])
    return learn([d for d, _ in rows], matrix, toxic, kernel)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = receive(shared)
        reader = Reader(model.kernel) if model.kernel else None
        for whole in batches:
            for batch in pieces(whole, "text", PIECE):
                found = model.scores(reader, strings(batch.column("text"))) if reader else [model.prior] * batch.num_rows
                columns = [batch.column(n) for n in batch.schema.names] + [pa.array(found, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "__tox"])
    return run


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id`, `held_out`, `score` and `predicted` of every document."""
    shared = send(docs.sparkSession, fit(docs, labels))
    found = texts(docs).mapInArrow(frugal(_score(shared)), "doc_id long, text string, __tox double")
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__tox").alias("score"),
        (F.col("__tox") >= 0.5).cast("int").alias("predicted"),
    )


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of `docs` that are not predicted toxic, all columns kept."""
    shared = send(docs.sparkSession, fit(docs, labels))
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)), F.col("text").alias("text"))
    schema = ", ".join(f"{n} {t}" for n, t in plain.dtypes) + ", __tox double"
    found = plain.mapInArrow(frugal(_score(shared)), schema).where("__tox < 0.5")
    return found.select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))
