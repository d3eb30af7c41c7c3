"""Exact distinct counts that merge: bitmaps of dictionary numbers.

A dictionary gives every value a number. Partials hold, per group and stretch of
32,768 numbers, the bitmap of the values seen. Bitmaps are merged with OR, in any
order and any number of times, so counts per file or day add up to counts
over all of them without a look at the rows again; a partial that is merged twice
changes nothing. Values are numbered within `SLICES` slices by hash, each
by a window of its own, so no task numbers all values.

Nulls are no values, as in `countDistinct`. A dictionary that is extended keeps the
numbers it gave; partials made with it before stay good.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICES = 64


def dictionary(df: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """`value` and `number` of the distinct values of a column, on top of those `known`."""
    values = df.select(F.col(f"`{column}`").cast("string").alias("value")).where("value IS NOT NULL").distinct()
    if known is not None:
        values = values.join(known.select("value"), "value", "left_anti")
    sliced = values.withColumn("slice", F.pmod(F.xxhash64("value"), F.lit(SLICES)))
    order = Window.partitionBy("slice").orderBy("value")
    place = F.row_number().over(order) - 1
    if known is not None:
        used = known.groupBy(F.pmod(F.col("number"), F.lit(SLICES)).alias("slice")).agg(
            (F.max(F.floor(F.col("number") / SLICES)) + 1).alias("used")
        )
        # One row for each slice.
        sliced = sliced.join(F.broadcast(used), "slice", "left")
        place = place + F.coalesce("used", F.lit(0))
    new = sliced.select("value", (place.cast("bigint") * SLICES + F.col("slice")).alias("number"))
    return new if known is None else known.select("value", "number").unionByName(new)


def partials(df: DataFrame, column: str, numbers: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Bitmaps of the values per `by`: `stretch` and `bits`. All values must be in the dictionary."""
    seen = df.select(*by, F.col(f"`{column}`").cast("string").alias("value")).distinct()
    numbered = seen.join(numbers, "value").select(*by, F.bitmap_bucket_number("number").alias("stretch"), "number")
    return numbered.groupBy(*by, "stretch").agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def merged(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Partials of coarser groups."""
    return parts.groupBy(*by, "stretch").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(parts: DataFrame, by: Sequence[str] = (), name: str = "n_distinct") -> DataFrame:
    """Distinct values per `by`; one row with 0 for no partials and no groups."""
    rows = merged(parts, by).withColumn("n", F.bitmap_count("bits"))
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias(name)
    return rows.groupBy(*by).agg(total) if by else rows.agg(total)
