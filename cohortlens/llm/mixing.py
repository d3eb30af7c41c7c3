"""Mixing sources to target weights by whole copies of documents.

Tokens are summed per source; a source's target over its size is its
repetition rate. Each document is emitted floor(rate) times, plus one
hash-seeded Bernoulli copy with probability equal to the fraction.

The mix draws with `SEEDS` seeds and keeps, for each source, the one whose total
comes nearest to the target: every draw is a Bernoulli draw of its own, and the
choice depends on sums per source alone. Reruns agree, for the draws hash the
document id.

Null texts and texts without words have size 0 and are taken by the same
draw. Repeated rows share their draw. A null source is a source of its own,
after the others. Other columns are kept by `mix` and not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .texts import WORD, kept

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all sizes
MOST = 2.0  # times a source's size
SEEDS = 32


def _draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) from eight hex digits of an MD5 sum."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed // 4}")).cast("binary"))
    return F.conv(F.substring(digest, 1 + 8 * (seed % 4), 8), 16, 10).cast("double") / float(2**32)


def source_targets(sizes: DataFrame) -> DataFrame:
    """`source`, `source_size`, `target` from `source` and `size`; one row per source.

    The targets are those that capping and resharing end at: a source whose cap
    per weight lies below the common level is capped, the others get the level
    times their weight.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Windows over one row per source.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.lit(list(WEIGHTS))
    per = per.withColumn("weight", F.element_at(weights, ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * F.lit(MOST))
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    below = by_level.rowsBetween(Window.unboundedPreceding, -1)
    # The level if this source and all after it stay uncapped.
    level = (
        F.lit(SHARE) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(below), F.lit(0.0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0)))
    per = per.withColumn("_level", level)
    # The level rises as long as sources are capped and falls after that: its peak is the common one.
    common = F.max("_level").over(everything)
    target = F.least(F.col("cap"), F.coalesce(common, F.lit(0.0)) * F.col("weight"))
    return per.select("source", "source_size", target.alias("target"))


def rates(docs: DataFrame) -> DataFrame:
    """`source`, `source_size`, `target`, `rate` and the `seed` whose draws come nearest to the target."""
    sized = _sized(docs)
    targets = kept(source_targets(sized))
    rated = targets.withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    )
    drawn = sized.join(rated.select(F.col("source").alias("_s"), "rate"), F.col("source").eqNullSafe(F.col("_s")))
    part = F.col("rate") - F.floor("rate")
    # One row per source: the extra words that each seed draws.
    sums = drawn.groupBy("source").agg(
        *(F.sum(F.when(_draw(F.col("doc_id"), k) < part, F.col("size")).otherwise(0)).alias(f"s{k}") for k in range(SEEDS))
    )
    t = rated.withColumnRenamed("source", "_s")
    wanted = F.col("target") - F.floor("rate") * F.col("source_size")
    nearest = F.array_min(F.array(*(F.struct(F.abs(F.col(f"s{k}") - wanted).alias("gap"), F.lit(k).alias("seed")) for k in range(SEEDS))))
    return kept(sums.join(t, F.col("source").eqNullSafe(F.col("_s"))).select(
        "source", "source_size", "target", "rate", nearest["seed"].alias("seed")
    ))


def _sized(docs: DataFrame) -> DataFrame:
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), size.alias("size"))


_PLAN = ("source", "source_size", "target", "rate", "seed")


def _copies(df: DataFrame, table: DataFrame) -> DataFrame:
    """Add `__mix_*` columns and `__mix_copies`.

    `table` has one row per source; its file size decides how it is joined.
    """
    columns = [F.col(c).alias(f"__mix_{c}") for c in _PLAN]
    joined = df.join(table.select(*columns), F.col("source").cast("string").eqNullSafe(F.col("__mix_source")))
    draws = F.coalesce(*(F.when(F.col("__mix_seed") == k, _draw(F.col("doc_id"), k)) for k in range(SEEDS)))
    rate = F.col("__mix_rate")
    return joined.withColumn("__mix_copies", (F.floor(rate) + (draws < rate - F.floor(rate)).cast("long")).cast("int"))


def taken(docs: DataFrame) -> DataFrame:
    """Per document: `doc_id`, `size`, `source_size`, `target`, `taken`."""
    return _copies(_sized(docs), rates(docs)).select(
        "doc_id", "size", F.col("__mix_source_size").alias("source_size"), F.col("__mix_target").alias("target"),
        (F.col("size") * F.col("__mix_copies")).alias("taken"),
    )


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of `docs`, each as often as it is taken."""
    columns = docs.columns
    counted = _copies(docs, rates(docs)).select(*columns, "__mix_copies")
    copies = F.explode(F.array_repeat(F.lit(1), F.col("__mix_copies"))).alias("__mix_copy")
    return counted.select(*columns, copies).select(*columns)


_DRAW = "('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':{j}'), {at}, 8))::BIGINT / 4294967296.0"
_DRAWS = [_DRAW.format(j=k // 4, at=1 + 8 * (k % 4)) for k in range(SEEDS)]

ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, list_extract({list(WEIGHTS)}, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1) AS weight,
    source_size * {MOST} AS cap FROM per
), levelled AS (
  SELECT *, ({SHARE} * sum(source_size) OVER () - coalesce(sum(cap) OVER below, 0.0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER below, 0)) AS level
  FROM weighted
  WINDOW below AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), rated AS (
  SELECT source, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM (
    SELECT *, least(cap, coalesce(max(level) OVER (), 0) * weight) AS target FROM levelled)
), drawn AS (
  SELECT s.doc_id, s.size, r.source, r.source_size, r.target, r.rate, [{', '.join(_DRAWS)}] AS draws
  FROM sized s JOIN rated r ON s.source IS NOT DISTINCT FROM r.source
), sums AS (
  SELECT source, k, abs(sum(CASE WHEN draws[k] < rate - floor(rate) THEN size ELSE 0 END)
    - (any_value(target) - floor(any_value(rate)) * any_value(source_size))) AS gap
  FROM drawn, range(1, {SEEDS + 1}) AS seeds(k) GROUP BY source, k
), chosen AS (
  SELECT source, k FROM sums QUALIFY row_number() OVER (PARTITION BY source ORDER BY gap, k) = 1
)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN draws[k] < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM drawn d JOIN chosen c ON d.source IS NOT DISTINCT FROM c.source
"""
