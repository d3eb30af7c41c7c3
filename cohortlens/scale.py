"""What the operators share to stay safe on large, skewed data.

* `stage` cuts lineage with a table written to the shared folder of the
  cluster, so a result used several times is computed once and survives the
  loss of executors. `workspace` owns such tables and deletes them.
* `running_totals` is a prefix sum that does not put a whole key in one task.
* `components` labels connected nodes by joins alone.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Iterator, Sequence
from contextvars import ContextVar
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

# Rows that one range of `running_totals` holds on average, and ranges at least.
RANGE_ROWS = 1_000_000
LEAST_RANGES = 4

_scope: ContextVar[str | None] = ContextVar("workspace", default=None)
_unowned: list[tuple[SparkSession, str]] = []


def shared_root(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`, which all executors reach; the warehouse where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged").rstrip("/")


def shared_folder(spark: SparkSession) -> str:
    """A new folder of the open `workspace`, or one that goes when the program ends."""
    owner = _scope.get()
    path = f"{owner or shared_root(spark)}/cohortlens-{uuid.uuid4().hex}"
    if owner is None:
        if not _unowned:
            atexit.register(_remove_unowned)
        _unowned.append((spark, path))
    return path


@contextlib.contextmanager
def workspace(spark: SparkSession) -> Iterator[str]:
    """Tables staged inside are deleted on leaving, so write the result before that."""
    path = f"{shared_root(spark)}/cohortlens-{uuid.uuid4().hex}"
    token = _scope.set(path)
    try:
        yield path
    finally:
        _scope.reset(token)
        remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _remove_unowned() -> None:
    for spark, path in _unowned:
        # A session that has been stopped can no longer reach its files.
        with contextlib.suppress(Exception):
            remove_folder(spark, path)


class Staged(NamedTuple):
    """A table in the shared folder and the number of its rows."""

    df: DataFrame
    rows: int


def stage(df: DataFrame) -> Staged:
    """Write `df` once to the shared folder and read it back; rows are counted on the way."""
    path = shared_folder(df.sparkSession)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    return Staged(back, seen.get["rows"])


def running_totals(
    table: Staged,
    keys: Sequence[str],
    order: str,
    value: str,
    out: str,
    scale_by: Sequence[str] | None = None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Add `out`: the sum of `value` over rows of the same key before this one.

    `table` has one row per (`keys`, `order`). It is cut into ranges of `order`, as
    many as its rows ask for: each range is summed on its own and shifted by the
    ranges before it, so the work of the largest key spreads over many tasks.
    `scale_by` (default: the first key) are the keys whose values of `order`
    differ in scale; they must be few.
    """
    keys, df = list(keys), table.df
    before = (Window.unboundedPreceding, -1)
    ranges = max(LEAST_RANGES, -(-table.rows // range_rows))
    cuts = [i / ranges for i in range(1, ranges)]
    scale_by = list(scale_by or keys[:1])
    bounds = df.groupBy(*scale_by).agg(F.percentile_approx(order, cuts, max(10_000, 20 * ranges)).alias("_b"))
    ranged = df.join(bounds, scale_by)
    ranged = ranged.withColumn("_r", F.size(F.filter("_b", lambda b: b < F.col(order)))).drop("_b")
    ranged = stage(ranged).df
    per_range = ranged.groupBy(*keys, "_r").agg(F.sum(value).alias("_n"))
    across = Window.partitionBy(*keys).orderBy("_r").rowsBetween(*before)
    shift = per_range.select(*keys, "_r", F.coalesce(F.sum("_n").over(across), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*keys, "_r").orderBy(order).rowsBetween(*before)
    return (
        ranged.join(shift, [*keys, "_r"])
        .withColumn(out, F.col("_shift") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_r", "_shift")
    )


def components(links: DataFrame) -> DataFrame:
    """`node` and `root`, the smallest node connected with it, of all nodes of the links `a`, `b`.

    Every round hangs each root below the smallest root next to its nodes and
    halves the paths. The links stay as they are; give few links per node (stars
    rather than all pairs).
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    table = stage(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root"))).df
    while True:
        ends = links.join(table.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").join(
            table.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b"
        )
        hooks = stage(
            ends.where("ra != rb").select(F.greatest("ra", "rb").alias("high"), F.least("ra", "rb").alias("low"))
            .groupBy("high").agg(F.min("low").alias("low"))
        )
        below = table.select(F.col("node").alias("root"), F.col("root").alias("above"))
        lower = hooks.df.select(F.col("high").alias("root"), F.col("low"))
        onward = table.join(lower, "root", "left").select("node", F.coalesce("low", "root").alias("root"))
        moved = F.col("above").isNotNull() & (F.col("above") != F.col("root"))
        seen = Observation()
        path = shared_folder(links.sparkSession)
        (
            onward.join(below, "root", "left").observe(seen, F.count_if(moved).alias("n"))
            .select("node", F.coalesce("above", "root").alias("root")).write.parquet(path)
        )
        table = links.sparkSession.read.schema(table.schema).parquet(path)
        if hooks.rows == 0 and seen.get["n"] == 0:
            return table
