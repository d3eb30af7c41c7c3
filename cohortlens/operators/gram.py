"""Moments of every pair of columns from one pass over the rows.

A row is never repeated per pair. Each task multiplies blocks of rows: with X the
values (0 where missing) and M the marks (1 where set), the counts of the pairs are
M'M, their sums X'M, their squares (X*X)'M and their products X'X. A task keeps these
matrices alone and gives one row per pair. Values are taken from the mean of the task's
first block, and tasks are merged around the mean of the pair, so nothing cancels.

Whether a column varies over the rows of a pair is exact: least and greatest values are
taken per pattern of missing values, and a pattern counts for the pairs that it has set.

Tables wider than `STRIPE` columns go through one pass for each two stripes, so memory
does not grow with the square of the columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scale import stage

# Columns of one stripe. Two stripes take six matrices of (2 * STRIPE) ** 2 numbers: 50 MB.
STRIPE = 512

_NUMBERS = ("mean_x", "mean_y", "xx", "yy", "xy", "low_x", "high_x", "low_y", "high_y")
_SCHEMA = "i int, j int, n long, " + ", ".join(f"{c} double" for c in _NUMBERS)
_ARROW = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("n", pa.int64()), *[(c, pa.float64()) for c in _NUMBERS]])


def _extremes(values: np.ndarray, marks: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
    """Lower `low[i, j]` and raise `high[i, j]` by the values of i in rows where j is set."""
    packed = np.ascontiguousarray(np.packbits(marks, axis=1))
    _, first, pattern = np.unique(packed.view(f"V{packed.shape[1]}").ravel(), return_index=True, return_inverse=True)
    order = np.argsort(pattern, kind="stable")
    starts = np.searchsorted(pattern[order], np.arange(len(first)))
    ordered = values[order]
    least, most = np.minimum.reduceat(ordered, starts), np.maximum.reduceat(ordered, starts)
    for k, row in enumerate(first):
        columns = np.flatnonzero(marks[row])
        if len(columns):
            both = np.ix_(columns, columns)
            low[both] = np.minimum(low[both], least[k, columns, None])
            high[both] = np.maximum(high[both], most[k, columns, None])


class Moments:
    """Sums over the rows of one task."""

    def __init__(self, width: int) -> None:
        self.center: np.ndarray | None = None
        self.n, self.sums, self.squares, self.products = (np.zeros((width, width)) for _ in range(4))
        self.low, self.high = np.full((width, width), np.inf), np.full((width, width), -np.inf)

    def add(self, block: np.ndarray) -> None:
        """Rows by columns; missing values are not a number."""
        set_ = ~np.isnan(block)
        marks = set_.astype(np.float64)
        values = np.where(set_, block, 0.0)
        _extremes(values, set_, self.low, self.high)
        if self.center is None:
            self.center = values.sum(axis=0) / np.maximum(marks.sum(axis=0), 1)
        values -= self.center * marks
        self.n += marks.T @ marks
        self.sums += values.T @ marks
        self.squares += (values * values).T @ marks
        self.products += values.T @ values

    def rows(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, ...]:
        """The columns of `_SCHEMA` but i and j, for pairs of places with rows."""
        n, sx, sy = self.n[i, j], self.sums[i, j], self.sums[j, i]
        return (
            n.astype(np.int64), self.center[i] + sx / n, self.center[j] + sy / n,
            np.maximum(self.squares[i, j] - sx * sx / n, 0), np.maximum(self.squares[j, i] - sy * sy / n, 0),
            self.products[i, j] - sx * sy / n,
            self.low[i, j], self.high[i, j], self.low[j, i], self.high[j, i],
        )


def _partials(df: DataFrame, columns: list[str], places: list[int], pairs: list[tuple[int, int]]) -> DataFrame:
    """One row per task and pair; `pairs` count within `places`, the places of the columns read."""
    left, right = (np.array(side, np.int64) for side in zip(*pairs))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments = Moments(len(places))
        for batch in batches:
            if batch.num_rows:
                moments.add(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
        if moments.center is None:
            return
        seen = moments.n[left, right] > 0
        i, j = left[seen], right[seen]
        names = np.array(places, np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, f.type) for a, f in zip((names[i], names[j], *moments.rows(i, j)), _ARROW)], schema=_ARROW
        )

    read = df.select(*[F.col(columns[p]).cast("double").alias(f"c{p}") for p in places])
    return read.mapInArrow(multiply, _SCHEMA)


def pair_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """(i, j, n, xx, yy, xy, varies) for places i < j of `columns`, over the rows where both are set.

    xx, yy and xy are sums of squared and multiplied differences from the means; `varies`
    tells that neither column is constant there. Null and NaN are missing; pairs without
    rows have no row.
    """
    stripes = [list(range(s, min(s + STRIPE, len(columns)))) for s in range(0, len(columns), STRIPE)]
    parts = []
    for a, b in combinations_with_replacement(stripes, 2):
        places = a if a is b else a + b
        pairs = [
            (x, y) for x in range(len(a)) for y in (range(x + 1, len(a)) if a is b else range(len(a), len(places)))
        ]
        if pairs:
            parts.append(_partials(df, columns, places, pairs))
    if not parts:
        return df.sparkSession.createDataFrame([], "i int, j int, n long, xx double, yy double, xy double, varies boolean")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    every = stage(every).df

    def mean(c: str) -> Column:
        return (F.sum(F.col("n") * F.col(c)) / F.sum("n")).alias(f"all_{c}")

    # One row per pair of columns.
    means = every.groupBy("i", "j").agg(mean("mean_x"), mean("mean_y"))
    x, y = F.col("mean_x") - F.col("all_mean_x"), F.col("mean_y") - F.col("all_mean_y")
    return every.join(F.broadcast(means), ["i", "j"]).groupBy("i", "j").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("xx") + F.col("n") * x * x).alias("xx"),
        F.sum(F.col("yy") + F.col("n") * y * y).alias("yy"),
        F.sum(F.col("xy") + F.col("n") * x * y).alias("xy"),
        ((F.min("low_x") < F.max("high_x")) & (F.min("low_y") < F.max("high_y"))).alias("varies"),
    )
