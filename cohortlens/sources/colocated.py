"""Plan and course tables that lie together, for plans that are matched again and again.

Both tables are bucketed and sorted by course, so their join reads bucket beside
bucket and shuffles nothing; the shuffle is paid once, when a table is written.
Renamed subjects are resolved at that time too.

A course that many plans ask for would fill one bucket, so the key also has a
number below `spread`, drawn from the major on the side of the plan; the course
side has each course once for every number. Plan rows without a course match
nothing; they are kept apart and never join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.matching import with_aliases
from ..schemas import COURSE_KEY

BUCKETS = 64
SPREAD = 8
KEYS = [*COURSE_KEY, "_spread"]


def _write(df: DataFrame, name: str, buckets: int) -> None:
    # Tasks and buckets are cut by the same hash: one file for each bucket.
    rows = df.repartition(buckets, *KEYS).sortWithinPartitions(*KEYS)
    rows.write.format("parquet").mode("overwrite").bucketBy(buckets, *KEYS).sortBy(*KEYS).saveAsTable(name)


def _has_course() -> str:
    return " AND ".join(f"{k} IS NOT NULL" for k in COURSE_KEY)


def keep_plan(plan: DataFrame, name: str, buckets: int = BUCKETS, spread: int = SPREAD) -> None:
    """Write plan rows as the tables `name` and `name`_apart (rows without a course)."""
    drawn = F.pmod(F.xxhash64("major"), F.lit(spread)).cast("int")
    _write(plan.where(_has_course()).withColumn("_spread", drawn), name, buckets)
    plan.where(f"NOT ({_has_course()})").write.format("parquet").mode("overwrite").saveAsTable(f"{name}_apart")


def keep_metrics(
    metrics: DataFrame, name: str, names: list[str], aliases: dict[str, list[str]] | None = None,
    buckets: int = BUCKETS, spread: int = SPREAD,
) -> None:
    """Write the metrics of courses, one row per course as `with_aliases` gives them, for `match_kept`.

    `buckets` and `spread` must be those of the plan.
    """
    rows = with_aliases(metrics, names, aliases).where(_has_course())
    numbers = F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("_spread")
    _write(rows.select(*COURSE_KEY, *names, numbers), name, buckets)


def match_kept(spark: SparkSession, plan: str, metrics: str, names: list[str]) -> DataFrame:
    """What `matching.attach_metrics` gives, from kept tables and without an exchange."""
    rows, apart = spark.table(plan), spark.table(f"{plan}_apart")
    columns = [c for c in rows.columns if c != "_spread"]
    joined = rows.join(spark.table(metrics).hint("merge"), KEYS, "left").select(*columns, *names)
    kinds = {f.name: f.dataType for f in spark.table(metrics).schema}
    nothing = [F.lit(None).cast(kinds[n]).alias(n) for n in names]
    return joined.unionByName(apart.select(*columns, *nothing))


def forget(spark: SparkSession, plan: str, metrics: str) -> None:
    for name in (plan, f"{plan}_apart", metrics):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
