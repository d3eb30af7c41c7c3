"""Approximate nearest neighbours by inner product, with learned partitions.

A bounded sample of the distinct vectors (at most `SAMPLE`, by a hash of the id)
gets an exact neighbour graph. The graph is cut into equal parts by recursive
bisection: a part is ordered along its smoothest eigenvector, split at the median
and mended by swaps that keep the balance. A small classifier learns to tell the
part of a vector. It places every vector of the table in its most probable part
and sends a query to the parts where it expects neighbours, until their
probability reaches `MASS`. Candidates are ranked by the exact inner product in
double precision.

Vectors of different lengths are brought to one length for the graph and the
classifier by one more component (0 for queries), which keeps the order of inner
products.

Copies of a vector are one entry with its `neighbours + 1` smallest ids: no more
of them can be among the answers. A part is cut into blocks of about `BLOCK`
vectors and a part's queries likewise, so a crowded part spreads over many tasks;
nothing is left out.

Vectors that are null, empty, zero, or hold null or non-finite components take no
part, nor do vectors of another length than most rows have. Null ids take no part.
Ties go to the smaller id; repeated rows count as one. Other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sharing import receive, send
from .texts import kept

SAMPLE = 8192
NEIGHBOURS = 12  # in the graph
PART = 128  # sampled vectors in a part, at least
MOST_PARTS = 64
MASS = 0.96
HIDDEN = 128
BLOCK = 2000


def _graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest rows of each row by inner product, itself left out."""
    out = np.empty((len(x), k), np.int64)
    for first in range(0, len(x), 1024):
        near = x[first : first + 1024] @ x.T
        near[np.arange(len(near)), first + np.arange(len(near))] = -np.inf
        out[first : first + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def _bisect(nodes: np.ndarray, edges: np.ndarray, n: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Split `nodes` into halves with few `edges` between them."""
    place = np.full(n, -1)
    place[nodes] = np.arange(len(nodes))
    own = place[edges]
    own = own[(own >= 0).all(axis=1)]
    a, b = np.concatenate((own[:, 0], own[:, 1])), np.concatenate((own[:, 1], own[:, 0]))
    size = len(nodes)
    degree = np.bincount(a, minlength=size) + 1e-9
    v = rng.standard_normal(size)
    for _ in range(60):  # the smoothest vector orthogonal to the constant one
        v -= (v * degree).sum() / degree.sum()
        v = (v + np.bincount(a, v[b], minlength=size) / degree) / 2
        v /= np.linalg.norm(v) + 1e-12
    side = np.zeros(size, bool)
    side[np.argsort(v, kind="stable")[size // 2 :]] = True
    for _ in range(10):  # swap those that gain most
        across = np.bincount(a, side[a] != side[b], minlength=size)
        gain = 2 * across - degree
        left, right = np.flatnonzero(~side & (gain > 0)), np.flatnonzero(side & (gain > 0))
        m = min(len(left), len(right)) // 2
        if m == 0:
            break
        side[left[np.argsort(-gain[left], kind="stable")[:m]]] = True
        side[right[np.argsort(-gain[right], kind="stable")[:m]]] = False
    return nodes[~side], nodes[side]


def partition_graph(near: np.ndarray, parts: int) -> np.ndarray:
    """Part of each row; parts differ by one row at most for a power of two."""
    n = len(near)
    edges = np.stack((np.repeat(np.arange(n), near.shape[1]), near.ravel()), axis=1)
    rng = np.random.default_rng(10)
    groups = [np.arange(n)]
    while len(groups) < parts:
        groups = [half for g in groups for half in _bisect(g, edges, n, rng)]
    out = np.empty(n, np.int64)
    for i, g in enumerate(groups):
        out[g] = i
    return out


class Router:
    """A classifier with one hidden layer from a vector to its part, and where its neighbours lie."""

    def __init__(self, x: np.ndarray, part: np.ndarray, near: np.ndarray, parts: int) -> None:
        rng = np.random.default_rng(11)
        n, d = x.shape
        # A vector's target is spread over its own part and its neighbours' ones.
        target = np.zeros((n, parts), np.float32)
        target[np.arange(n), part] = 1
        for j in range(near.shape[1]):
            np.add.at(target, (np.arange(n), part[near[:, j]]), 1.0)
        target /= target.sum(axis=1, keepdims=True)
        self.parts = parts
        self.w = [
            (rng.standard_normal((d, HIDDEN)) * np.sqrt(2 / d)).astype(np.float32), np.zeros(HIDDEN, np.float32),
            (rng.standard_normal((HIDDEN, parts)) * np.sqrt(1 / HIDDEN)).astype(np.float32), np.zeros(parts, np.float32),
        ]
        slope = [np.zeros_like(w) for w in self.w]
        square = [np.zeros_like(w) for w in self.w]
        t = 0
        for _ in range(30):
            for rows in np.array_split(rng.permutation(n), max(1, n // 256)):
                t += 1
                xs = x[rows]
                h = np.maximum(xs @ self.w[0] + self.w[1], 0)
                gap = (self._softmax(h @ self.w[2] + self.w[3]) - target[rows]) / len(rows)
                back = (gap @ self.w[2].T) * (h > 0)
                for i, g in enumerate((xs.T @ back, back.sum(0), h.T @ gap, gap.sum(0))):
                    g = g + 1e-5 * self.w[i]
                    slope[i] = 0.9 * slope[i] + 0.1 * g
                    square[i] = 0.999 * square[i] + 0.001 * g * g
                    self.w[i] -= 0.003 * (slope[i] / (1 - 0.9**t)) / (np.sqrt(square[i] / (1 - 0.999**t)) + 1e-8)

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self._softmax(np.maximum(x @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3])

    def likely(self, x: np.ndarray, mass: float) -> list[np.ndarray]:
        """Parts of each row, the most probable first, until they reach `mass`."""
        p = self(x)
        order = np.argsort(-p, axis=1, kind="stable")
        total = np.cumsum(np.take_along_axis(p, order, 1), axis=1)
        return [o[: int((t < mass).sum()) + 1] for o, t in zip(order, total)]


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Rows of one length `longest`, by one more component; scaled to 1."""
    rest = np.sqrt(np.maximum(longest**2 - (x**2).sum(axis=1), 0))
    return (np.concatenate((x, rest[:, None]), axis=1) / longest).astype(np.float32)


def _as_query(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return (np.concatenate((x, np.zeros((len(x), 1))), axis=1) / size).astype(np.float32)


def _matrix(column) -> np.ndarray:
    data = column.to_pylist() if isinstance(column, pa.Array) else list(column)
    return np.frombuffer(b"".join(data), np.float64).reshape(len(data), -1)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors as bytes of doubles."""
    for batch in batches:
        ids, rows, sizes = [], [], []
        for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist()):
            if i is None or not v or any(c is None for c in v):
                continue
            x = np.asarray(v, np.float64) + 0.0  # -0.0 and 0.0 are one vector
            if np.isfinite(x).all() and x.any():
                ids.append(i)
                rows.append(x.tobytes())
                sizes.append(len(x))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(rows, pa.binary()), pa.array(sizes, pa.int32())], ["vec_id", "vec", "width"]
        )


class Index:
    """Distinct vectors with their smallest ids and their part; and the router."""

    def __init__(self, vectors: DataFrame, neighbours: int) -> None:
        spark = vectors.sparkSession
        packed = vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(
            _pack, "vec_id long, vec binary, width int")
        packed = kept(packed)
        widths = packed.groupBy("width").count().orderBy(F.desc("count"), "width").limit(1).collect()
        self.width = widths[0]["width"] if widths else 0
        self.neighbours = neighbours
        self.packed = packed.where(F.col("width") == self.width).select("vec_id", "vec")
        # A rank of at most `neighbours + 1` is cut before the shuffle, so many copies do not meet in one task.
        rank = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
        few = self.packed.distinct().withColumn("rank", rank).where(F.col("rank") <= neighbours + 1)
        self.entries = kept(few.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
        self.router: Router | None = None
        self.longest = 1.0
        if self.width:
            self._learn()
            shared = send(spark, (self.router, self.longest))
            placed = self.entries.mapInArrow(_place(shared), "vec binary, ids array<long>, part int")
            self.placed = kept(placed)

    def _learn(self) -> None:
        sample = self.entries.orderBy(F.xxhash64(F.col("ids")[0]), F.col("ids")[0]).limit(SAMPLE).select("vec").collect()
        x = np.frombuffer(b"".join(bytes(r[0]) for r in sample), np.float64).reshape(len(sample), self.width)
        squares = self.entries.mapInArrow(_longest, "size double").agg(F.max("size")).first()[0]
        self.longest = float(squares)
        parts = 1
        while parts * 2 * PART <= len(x) and parts * 2 <= MOST_PARTS:
            parts *= 2
        if parts == 1:
            return
        lifted = _lifted(x, self.longest)
        near = _graph(lifted, min(NEIGHBOURS, len(x) - 1))
        self.router = Router(lifted, partition_graph(near, parts), near, parts)

    def search(self, queries: DataFrame) -> DataFrame:
        """Per row of `queries` (`vec_id`): `query_id`, `rank`, `vec_id`, `score` of its nearest other rows."""
        spark = queries.sparkSession
        if not self.width:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        asked = self.packed.join(queries.select(F.col("vec_id").cast("long")).distinct(), "vec_id", "left_semi").distinct()
        asked = kept(asked)
        shared = send(spark, self.router)
        routed = asked.select("vec").distinct().mapInArrow(_route(shared), "vec binary, part int")
        routed = kept(routed)
        # Blocks of parts; counts of at most MOST_PARTS parts reach the driver.
        rows = {r["part"]: r["n"] for r in self.placed.groupBy("part").agg(F.count("*").alias("n")).collect()}
        asks = {r["part"]: r["n"] for r in routed.groupBy("part").agg(F.count("*").alias("n")).collect()}
        sizes = spark.createDataFrame(
            [(p, -(-n // BLOCK), -(-asks.get(p, 0) // BLOCK)) for p, n in rows.items()], "part int, c_blocks int, q_blocks int")
        sizes = F.broadcast(sizes)
        mine, every = (F.pmod(F.xxhash64("vec"), F.col(n)).cast("int") for n in ("c_blocks", "q_blocks"))

        def all_of(n: str):
            return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

        entries = self.placed.join(sizes, "part").where("q_blocks > 0").select(
            "part", mine.alias("c"), all_of("q_blocks").alias("q"), "vec", "ids")
        wanted = routed.join(sizes, "part").select("part", all_of("c_blocks").alias("c"), every.alias("q"), "vec")
        cell = ["part", "c", "q"]
        found = wanted.groupBy(*cell).cogroup(entries.groupBy(*cell)).applyInPandas(
            _nearest(self.neighbours), "vec binary, vec_id long, score double")
        best = Window.partitionBy("vec").orderBy(F.desc("score"), "vec_id")
        top = kept(
            found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= self.neighbours + 1)
            .groupBy("vec").agg(F.collect_list(F.struct("place", "vec_id", "score")).alias("top")),
        )
        own = F.filter(F.array_sort("top"), lambda t: t["vec_id"] != F.col("query_id"))
        return (
            asked.withColumnRenamed("vec_id", "query_id").join(top, "vec")
            .select("query_id", F.posexplode(F.slice(own, 1, self.neighbours)).alias("at", "t"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "t.vec_id", "t.score")
        )


def _longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            size = float(np.linalg.norm(_matrix(batch.column("vec")), axis=1).max())
            yield pa.RecordBatch.from_arrays([pa.array([size])], ["size"])


def _place(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router, longest = receive(shared)
        for batch in batches:
            part = np.zeros(batch.num_rows, np.int32)
            if router and batch.num_rows:
                part = router(_lifted(_matrix(batch.column("vec")), longest)).argmax(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part)], ["vec", "ids", "part"])
    return run


def _route(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = receive(shared)
        for batch in batches:
            if not batch.num_rows:
                continue
            chosen = [np.zeros(1, np.int64)] * batch.num_rows
            if router:
                chosen = router.likely(_as_query(_matrix(batch.column("vec"))), MASS)
            rows = np.repeat(np.arange(batch.num_rows), [len(c) for c in chosen])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec").take(pa.array(rows)), pa.array(np.concatenate(chosen).astype(np.int32))], ["vec", "part"])
    return run


def _nearest(neighbours: int):
    def run(queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(entries):
            return pd.DataFrame({"vec": [], "vec_id": [], "score": []})
        q, e = _matrix(queries["vec"]), _matrix(entries["vec"])
        ids = list(entries["ids"])
        vec, vec_id, score = [], [], []
        keep = min(len(e), neighbours + 1)
        for first in range(0, len(q), 256):
            near = q[first : first + 256] @ e.T
            # All that reach the last kept value, with room for rounding: ties are settled below.
            bound = np.partition(near, len(e) - keep, axis=1)[:, len(e) - keep]
            bound = bound - 1e-9 * np.maximum(1, np.abs(bound))
            for i in range(len(near)):
                at = np.flatnonzero(near[i] >= bound[i])
                # One product after the other: the same value wherever a vector stands.
                exact = np.cumsum(e[at] * q[first + i], axis=1)[:, -1]
                names = np.concatenate([np.asarray(ids[j], np.int64) for j in at])
                values = np.repeat(exact, [len(ids[j]) for j in at])
                best = np.lexsort((names, -values))[: neighbours + 1]
                vec += [queries["vec"].iat[first + i]] * len(best)
                vec_id.append(names[best])
                score.append(values[best])
        return pd.DataFrame({"vec": vec, "vec_id": np.concatenate(vec_id), "score": np.concatenate(score)})
    return run


def nearest(vectors: DataFrame, queries: DataFrame, neighbours: int = 20) -> DataFrame:
    """The nearest rows of `vectors` (`vec_id`, `embedding`) for each row that `queries` names by `vec_id`."""
    return Index(vectors, neighbours).search(queries)
