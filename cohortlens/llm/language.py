"""Language-model scoring with a gated recurrent network.

Tokens are lower-cased words and one end per text. Corpus counts cover all
training texts. The `WORDS` most frequent words are predicted one by one, in
`CLASSES` classes of equal size by rank: the output is factored into the class
and the word within the class, both softmax of the hidden state. A word beyond
them belongs to one class of its own, inside which it has its corpus share; what
was never seen shares the probability that the words seen once suggest
(Good-Turing). So the probabilities of all texts add up to one.

Training is truncated backpropagation over windows of `STEPS` tokens; the hidden
state is carried from window to window and reset where a document begins. Every
partition trains a replica on all its training documents, and the replicas are
averaged by Spark, weighted by their tokens: work and data grow with the corpus.
So scores depend a little on how the table is cut into partitions. Before that,
`WARM` documents (by hash, of those with at most `WARM_BYTES`) train the common
start on the driver.
A stream long enough for `LEAST` windows to a lane is run in up to `LANES` lanes,
a shorter one in `FEW` at most.

Scoring runs over whole texts and carries the state through; texts of a batch
run side by side, the longest first. Counts of the `TABLE` most frequent words
go to every executor (16 bytes each); occurrences of the others are joined with
the count table.

Null texts count as empty: one end token. Documents with a null id are training
documents. Repeated rows are scored alike and all counted. Other columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sharing import receive, send
from .texts import bytes_of, kept, pieces, texts, word_hashes

CLASSES = 64
WORDS = CLASSES * CLASSES
TABLE = 1 << 18
SLOTS = 1 << 20  # of the index over the table, addressed by the low bits of a hash
HIDDEN = 24
STEPS = 32
FEW, LANES, LEAST = 64, 512, 32
WARM, WARM_BYTES = 400, 1 << 16
SIDE = 1024  # texts scored side by side
ROWS = 2048  # of outputs worked through at a time
HELD = 1 << 15  # states held for the outputs while scoring
END_WORD = np.int64(-1)  # stands for the end in the count table
RARE, END, BEGIN = WORDS, WORDS + 1, WORDS + 2


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, counts, ends = [], [], 0

    def emit() -> pa.RecordBatch:
        nonlocal ends
        words, place = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(place, np.concatenate(counts), len(words)).astype(np.int64)
        keys.clear()
        counts.clear()
        words, n = np.append(words.view(np.int64), END_WORD), np.append(n, ends)
        ends = 0
        return pa.RecordBatch.from_arrays([pa.array(words), pa.array(n)], ["word", "n"])

    for whole in batches:
        for batch in pieces(whole, "text", 2 << 20):
            hashes, _ = word_hashes(*bytes_of(batch.column("text")))
            words, n = np.unique(hashes, return_counts=True)
            keys.append(words)
            counts.append(n)
            ends += batch.num_rows
            if sum(map(len, keys)) > 1_000_000:
                yield emit()
    if keys:
        yield emit()


class Table:
    """The most frequent words with their counts, and the sums over all words."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, ends: int, tokens: int, distinct: int, once: int) -> None:
        self.words, self.by_rank = words, counts  # by rank
        self.slots: np.ndarray | None = None
        self.ends, self.tokens, self.distinct = ends, tokens, distinct
        self.rare = tokens - ends - int(counts[:WORDS].sum())
        self.unseen = min(max(once / self.rare, 1e-6), 0.5) if self.rare > 0 else 1.0

    def __getstate__(self) -> dict:
        """The index is built where it is used, not sent."""
        return self.__dict__ | {"slots": None, "shared": None, "order": None}

    def _index(self) -> None:
        """The first word by rank of every slot, and the slots that more words ask for."""
        slot = self.words & (SLOTS - 1)
        self.slots = np.full(SLOTS, -1, np.int32)
        self.slots[slot[::-1]] = np.arange(len(slot) - 1, -1, -1, dtype=np.int32)
        self.shared = np.bincount(slot, minlength=SLOTS) > 1
        self.order = np.argsort(self.words)

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (-1: not in the table) and count of each word."""
        if not len(self.words):
            return np.full(len(hashes), -1), np.zeros(len(hashes), np.int64)
        if self.slots is None:
            self._index()
        words = hashes.view(np.int64)
        slot = words & (SLOTS - 1)
        rank = self.slots[slot]
        wrong = np.flatnonzero((self.words[rank] != words) | (rank < 0))
        # Another word of the same slot.
        other = wrong[self.shared[slot[wrong]]]
        rank[wrong] = -1
        if len(other):
            asked = words[other]
            place = np.minimum(np.searchsorted(self.words, asked, sorter=self.order), len(self.words) - 1)
            found = self.order[place]
            rank[other] = np.where(self.words[found] == asked, found, -1)
        return rank, np.where(rank >= 0, self.by_rank[rank], 0)


def tokens(table: Table, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token numbers of the words of all texts, the places where texts begin, ranks and counts."""
    hashes, at = word_hashes(*bytes_of(batch.column("text")))
    rank, count = table.look_up(hashes)
    return np.where((rank >= 0) & (rank < WORDS), rank, RARE).astype(np.int32), at, rank, count, hashes


def _with_ends(numbers: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same with an end after each text."""
    n = len(at) - 1
    out = np.full(len(numbers) + n, END, np.int32)
    out[np.arange(len(numbers)) + np.repeat(np.arange(n), np.diff(at))] = numbers
    return out, at + np.arange(n + 1)


def _large(w: np.ndarray) -> np.ndarray:
    """Whether the logits by these weights could overflow: states lie within -1 and 1, the last row is the bias."""
    return np.abs(w[..., :-1, :]).sum(axis=-2).max(axis=-1) + w[..., -1, :].max(axis=-1) > 60


def _softmax(h: np.ndarray, w: np.ndarray, large: bool, goal: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of the goal of each row; with `back`, the second result is the gradient by the logits.

    The last entry of a row of `h` is 1, the last row of `w` the bias.
    """
    e = h @ w
    if large:
        np.minimum(e, 60, out=e)
    rows = np.arange(len(h))
    log_p = e[rows, goal]
    np.exp(e, out=e)
    total = e @ np.ones(e.shape[1], e.dtype)
    log_p -= np.log(total)
    if back:
        e *= (1 / total)[:, None]
        e[rows, goal] -= 1
    return log_p, e


class Network:
    """Weights: input table, recurrent weights, class outputs, word outputs."""

    NAMES = ("table", "u", "class_w", "class_b", "word_w", "word_b")

    def __init__(self, weights: dict[str, np.ndarray]) -> None:
        self.w = weights

    @classmethod
    def start(cls, counts: Table) -> Network:
        rng = np.random.default_rng(8)
        h, c = HIDDEN, CLASSES + 2
        known = np.zeros(WORDS)
        known[: min(WORDS, len(counts.by_rank))] = counts.by_rank[:WORDS]
        known = known.reshape(CLASSES, CLASSES)
        mass = np.append(known.sum(axis=1), (max(counts.rare, 0), counts.ends))
        # A class without words has no probability.
        with np.errstate(divide="ignore"):
            word_b = np.where(known > 0, np.log(np.maximum(known, 1e-30)), -1e9)
        return cls({k: v.astype(np.float32) for k, v in {
            "table": rng.standard_normal((WORDS + 3, 3 * h)) * 0.1,
            "u": rng.standard_normal((h, 3 * h)) * np.sqrt(1 / h),
            "class_w": rng.standard_normal((h, c)) * 0.05,
            "class_b": np.where((mass > 0) | (np.arange(c) >= CLASSES), np.log(np.maximum(mass, 0.5)), -1e9),
            "word_w": rng.standard_normal((CLASSES, h, CLASSES)) * 0.05,
            "word_b": word_b,
        }.items()})

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """One step; gates are returned for the way back.

        A column of `x` (3 x HIDDEN rows, from the input table) and of the states
        `h` is a lane, so each gate is one stretch of memory.
        """
        n = HIDDEN
        g = self.w["u"].T @ h
        zr = x[: 2 * n] + g[: 2 * n]
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        z, r, far = zr[:n], zr[n:], g[2 * n :]
        new = r * far
        new += x[2 * n :]
        np.tanh(new, out=new)
        out = new - h
        out *= z
        out += h
        return out, z, r, new, far

    def outputs(self, h: np.ndarray, target: np.ndarray, back: bool = False):
        """Log probability of each target from its hidden state (a row); with `back`, also the gradients."""
        w = self.w
        group = np.where(target < WORDS, target // CLASSES, CLASSES + target - WORDS).astype(np.int16)
        order = np.argsort(group, kind="stable")
        group, word = group[order], (target % CLASSES)[order]
        h = np.concatenate((h, np.ones((len(h), 1), h.dtype)), axis=1)[order]
        class_w = np.concatenate((w["class_w"], w["class_b"][None]))
        word_w = np.concatenate((w["word_w"], w["word_b"][:, None]), axis=1)
        class_large, word_large = bool(_large(class_w)), _large(word_w).tolist()
        log_p = np.empty(len(h), h.dtype)
        if back:
            class_g, word_g, dh = np.zeros_like(class_w), np.zeros_like(word_w), np.empty((len(h), HIDDEN), h.dtype)
        for first in range(0, len(h), ROWS):
            part = slice(first, first + ROWS)
            log_p[part], gap = _softmax(h[part], class_w, class_large, group[part], back)
            if back:
                class_g += h[part].T @ gap
                dh[part] = gap @ w["class_w"].T
        bounds = np.searchsorted(group, np.arange(CLASSES + 1)).tolist()
        for c in range(CLASSES):
            for first in range(bounds[c], bounds[c + 1], ROWS):
                part = slice(first, min(first + ROWS, bounds[c + 1]))
                more, gap = _softmax(h[part], word_w[c], word_large[c], word[part], back)
                log_p[part] += more
                if back:
                    word_g[c] += h[part].T @ gap
                    dh[part] += gap @ w["word_w"][c].T
        out = np.empty_like(log_p)
        out[order] = log_p
        if not back:
            return out
        turned = np.empty_like(dh)
        turned[order] = dh
        grad = {"class_w": class_g[:-1], "class_b": class_g[-1], "word_w": word_g[:, :-1], "word_b": word_g[:, -1]}
        return out, grad, turned

    def inputs(self, numbers: np.ndarray) -> np.ndarray:
        """Rows of the input table for steps x lanes, turned: steps x 3 HIDDEN x lanes."""
        return np.ascontiguousarray(self.w["table"][numbers].transpose(0, 2, 1))

    def window(self, before: np.ndarray, target: np.ndarray, h: np.ndarray) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
        """Loss, gradients and last state of one window; rows are lanes, columns steps. A target of -1 is padding."""
        lanes, steps = before.shape
        n = HIDDEN
        ids, goal = np.ascontiguousarray(before.T), target.T.reshape(-1)
        x = self.inputs(ids)
        states, kept_ = np.empty((steps, n, lanes), x.dtype), []
        for t in range(steps):
            fresh = np.flatnonzero(ids[t] == BEGIN)
            if len(fresh):
                h = h.copy()
                h[:, fresh] = 0
            old = h
            h, *gates = self.step(x[t], h)
            kept_.append((old, fresh, *gates))
            states[t] = h
        flat = states.transpose(0, 2, 1).reshape(-1, n)
        real = goal >= 0
        if real.all():
            log_p, grad, dh = self.outputs(flat, goal, True)
        else:
            dh = np.zeros_like(flat)
            log_p, grad, dh[real] = self.outputs(flat[real], goal[real], True)
        dh = np.ascontiguousarray(dh.reshape(steps, lanes, n).transpose(0, 2, 1))
        grad["u"] = np.zeros_like(self.w["u"])
        dx = x  # read no more
        d_g = np.empty((3 * n, lanes), x.dtype)
        carry = np.zeros((n, lanes), x.dtype)
        for t in range(steps - 1, -1, -1):
            old, fresh, z, r, new, far = kept_[t]
            d = dh[t] + carry
            dz = d * z
            d_new = dz * (1 - new * new)
            dx[t, :n] = dz * (new - old) * (1 - z)
            dx[t, n : 2 * n] = d_new * far * r * (1 - r)
            dx[t, 2 * n :] = d_new
            d_g[: 2 * n] = dx[t, : 2 * n]
            np.multiply(d_new, r, out=d_g[2 * n :])
            grad["u"] += old @ d_g.T
            carry = d - dz + self.w["u"] @ d_g
            carry[:, fresh] = 0
        flat_x, ids = dx.transpose(0, 2, 1).reshape(-1, 3 * n), ids.reshape(-1)
        # A radix sort: token numbers have 16 bits.
        order = np.argsort(ids.astype(np.int16), kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(ids[order]) != 0))
        grad["rows"] = ids[order][first]
        grad["table"] = np.add.reduceat(flat_x[order], first, axis=0)
        return float(-log_p.sum()), grad, h

    def train(self, stream: np.ndarray, rate: float, square: dict[str, np.ndarray] | None = None) -> dict[str, np.ndarray]:
        """Run over a stream of texts, each with its end, in lanes side by side.

        `square` holds the mean squares of the gradients so far, and is returned.
        """
        if square is None:
            square = {k: np.full_like(v, np.float32(1e-8)) for k, v in self.w.items()}
        if not len(stream):
            return square
        windows = len(stream) // STEPS
        lanes = int(max(1, min(FEW, windows), min(LANES, windows // LEAST)))
        length = -(-len(stream) // lanes)
        pad = lanes * length - len(stream)
        before = np.append(np.int32(END), stream[:-1])
        before = np.append(np.where(before == END, BEGIN, before), np.full(pad, BEGIN, np.int32)).reshape(lanes, length)
        target = np.append(stream, np.full(pad, -1, np.int32)).reshape(lanes, length)
        h = np.zeros((HIDDEN, lanes), np.float32)
        for t in range(0, length, STEPS):
            x, y = before[:, t : t + STEPS], target[:, t : t + STEPS]
            _, grad, h = self.window(x, y, h)
            scale = np.float32(1 / max(1, int((y >= 0).sum())))
            rows = grad.pop("rows")
            for k, g in grad.items():
                g = np.clip(g * scale, -0.1, 0.1)
                if k == "table":
                    square[k][rows] = 0.99 * square[k][rows] + 0.01 * g * g
                    self.w[k][rows] -= rate * g / (np.sqrt(square[k][rows]) + 1e-5)
                else:
                    square[k] = 0.99 * square[k] + 0.01 * g * g
                    self.w[k] -= rate * g / (np.sqrt(square[k]) + 1e-5)
        return square

    def score(self, streams: list[np.ndarray]) -> np.ndarray:
        """Natural log probability of each text (with its end), texts side by side."""
        out = np.zeros(len(streams))
        order = sorted(range(len(streams)), key=lambda i: -len(streams[i]))
        for first in range(0, len(order), SIDE):
            group = order[first : first + SIDE]
            sizes = np.array([len(streams[i]) for i in group])
            flat = np.concatenate([streams[i] for i in group])
            starts = np.cumsum(sizes) - sizes
            h = np.zeros((HIDDEN, len(group)), np.float32)
            last = np.full(len(group), BEGIN, np.int32)
            total = np.zeros(len(group))
            held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # states, goals and texts of windows

            def add() -> None:
                """Outputs of the held windows at once: late windows have few texts."""
                states, goals, owners = (np.concatenate(side) for side in zip(*held))
                held.clear()
                np.add(total, np.bincount(owners, self.outputs(states, goals), len(group)), out=total)

            for t in range(0, int(sizes[0]), 64):
                steps = np.arange(t, int(min(t + 64, sizes[0])))
                live = np.searchsorted(-sizes, -steps, "left")  # texts longer than so many tokens
                alive = int(live[0])
                # Steps x texts; beyond the end of a text anything may stand, for it is not read.
                block = flat[np.minimum(starts[:alive] + steps[:, None], len(flat) - 1)]
                x = self.inputs(np.concatenate((last[None, :alive], block[:-1])))
                states = []
                for j, n in enumerate(live.tolist()):
                    h = self.step(x[j, :, :n], h[:, :n])[0]
                    states.append(h.T)
                last = block[-1]
                real = np.arange(alive) < live[:, None]
                held.append((np.concatenate(states), block[real], np.nonzero(real)[1]))
                if sum(len(goals) for _, goals, _ in held) >= HELD:
                    add()
            if held:
                add()
            out[group] = total
        return out


def _streams(numbers: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    full, ends = _with_ends(numbers, at)
    return [full[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _train(shared):
    """One replica per partition: its weights times its tokens, and the tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, weights = receive(shared)
        net, seen, square = Network({k: v.copy() for k, v in weights.items()}), 0, None
        for whole in batches:
            for batch in pieces(whole, "text", 8 << 20):
                numbers, at, *_ = tokens(table, batch)
                stream, _ = _with_ends(numbers, at)
                square = net.train(stream, 0.005, square)
                seen += len(stream)
        if seen:
            parts = [(k, i, p) for k in Network.NAMES for i, p in enumerate(np.array_split(net.w[k].ravel(), _blocks(net.w[k].size)))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k for k, _, _ in parts]), pa.array([i for _, i, _ in parts], pa.int32()),
                    pa.array([(p.astype(np.float64) * seen).tobytes() for _, _, p in parts], pa.binary()),
                    pa.array([seen] * len(parts), pa.int64()),
                ],
                ["name", "block", "sum", "tokens"],
            )
    return run


def _blocks(size: int) -> int:
    return max(1, size // 8192)


def _add(key: tuple, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of one block of weights over the replicas, taken as they come."""
    total, seen = None, 0
    for batch in rows:
        for part, n in zip(batch.column("sum").to_pylist(), batch.column("tokens").to_pylist()):
            own = np.frombuffer(part, np.float64)
            total = own.copy() if total is None else total + own
            seen += n
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[0].as_py()]), pa.array([key[1].as_py()], pa.int32()), pa.array([(total / seen).astype(np.float32).tobytes()], pa.binary())],
        ["name", "block", "mean"],
    )


def counts(docs: DataFrame) -> DataFrame:
    """`word` (a hash; -1 for the end) and its count `c` over the training texts."""
    rows = texts(docs.where(~held_out(F.col("doc_id"))))
    counted = rows.select("text").mapInArrow(_count, "word long, n long")
    return kept(counted.groupBy("word").agg(F.sum("n").alias("c")))


def frequent(words: DataFrame) -> Table:
    """At most `TABLE` words reach the driver."""
    spark_words = words.where(F.col("word") != int(END_WORD))
    total = words.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"), F.count("*").alias("distinct"),
        F.count(F.when((F.col("c") == 1) & (F.col("word") != int(END_WORD)), 1)).alias("once"),
        F.coalesce(F.sum(F.when(F.col("word") == int(END_WORD), F.col("c"))), F.lit(0)).alias("ends"),
    ).first()
    top = spark_words.orderBy(F.desc("c"), "word").limit(TABLE).toArrow()
    return Table(
        top.column("word").to_numpy(), top.column("c").to_numpy(), total["ends"], total["tokens"], total["distinct"], total["once"])


def learn(docs: DataFrame, table: Table) -> Network:
    spark = docs.sparkSession
    rows = texts(docs.where(~held_out(F.col("doc_id"))))
    net = Network.start(table)
    # By id and text, so that a text with many copies has no more than its share; keys first, so that no task
    # collects texts. Repeated rows share a key.
    key = F.xxhash64("doc_id", "text")
    short = rows.where(F.octet_length("text") <= WARM_BYTES).withColumn("key", key)
    few = short.select("key").distinct().orderBy("key").limit(WARM)
    warm = short.join(F.broadcast(few), "key").dropDuplicates(["key"]).orderBy("key").select("text").toArrow().combine_chunks()
    for batch in warm.to_batches():
        numbers, at, *_ = tokens(table, batch)
        net.train(_with_ends(numbers, at)[0], 0.03)
    shared = send(spark, (table, net.w))
    replicas = rows.select("text").mapInArrow(_train(shared), "name string, block int, sum binary, tokens long")
    means = replicas.groupBy("name", "block").applyInArrow(_add, "name string, block int, mean binary").collect()
    by_name: dict[str, list[tuple[int, bytes]]] = {}
    for name, block, mean in means:  # as many rows as the network has blocks
        by_name.setdefault(name, []).append((block, bytes(mean)))
    for name, parts in by_name.items():
        flat = np.concatenate([np.frombuffer(m, np.float32) for _, m in sorted(parts)])
        net.w[name] = flat.reshape(net.w[name].shape)
    return net


_PASS = (
    "doc_id long, n_tokens long, n_known long, base double, model double, "
    "rest array<struct<word:bigint,n:bigint>>"
)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, weights = receive(shared)
        net = Network(weights)
        for whole in batches:
            for batch in pieces(whole, "text", 8 << 20):
                numbers, at, rank, count, hashes = tokens(table, batch)
                log_p = net.score(_streams(numbers, at)) / np.log(10)
                n = len(at) - 1
                owner = np.repeat(np.arange(n), np.diff(at))
                base = np.bincount(owner, np.log10(count + 1.0) * (rank >= 0), n)
                rare = rank >= WORDS
                share = np.bincount(owner[rare], np.log10(count[rare] * (1 - table.unseen) / max(table.rare, 1)), n)
                known = np.bincount(owner, rank >= 0, n).astype(np.int64) + (table.ends > 0)
                # Words beyond the table, counted per text.
                far = np.flatnonzero(rank < 0)
                pairs = np.lexsort((hashes[far], owner[far]))
                own, word = owner[far][pairs], hashes[far][pairs].view(np.int64)
                new = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (word[1:] != word[:-1]))) if len(own) else np.empty(0, np.int64)
                times = np.diff(np.append(new, len(own)))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(own[new], np.arange(n + 1)).astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(word[new]), pa.array(times.astype(np.int64))], ["word", "n"]),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), pa.array(np.diff(at).astype(np.int64) + 1), pa.array(known),
                        pa.array(base + np.log10(table.ends + 1.0)), pa.array(log_p + share), lists,
                    ],
                    ["doc_id", "n_tokens", "n_known", "base", "model", "rest"],
                )
    return run


def scores(docs: DataFrame) -> DataFrame:
    """Per document: `doc_id`, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`."""
    spark = docs.sparkSession
    words = counts(docs)
    table = frequent(words)
    net = learn(docs, table)
    shared = send(spark, (table, net.w))
    passed = kept(
        texts(docs).mapInArrow(_score(shared), _PASS).withColumn("row", F.monotonically_increasing_id()))
    far = passed.select("row", F.explode("rest").alias("r")).select("row", "r.word", "r.n")
    seen = F.col("c").isNotNull()
    share = F.log10(F.col("c") * (1 - table.unseen) / float(max(table.rare, 1)))
    summed = far.join(words, "word", "left").groupBy("row").agg(
        F.sum(F.when(seen, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.when(seen, F.col("n") * F.log10(F.col("c") + 1)).otherwise(0.0)).alias("more_base"),
        F.sum(F.col("n") * F.when(seen, share).otherwise(float(np.log10(table.unseen)))).alias("more_model"),
    )
    zero = F.lit(0.0)
    norm = float(np.log10(table.tokens + table.distinct + 1))
    return passed.drop("rest").join(summed, "row", "left").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(table.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero) - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("model") + F.coalesce("more_model", zero)).alias("score"),
    )
