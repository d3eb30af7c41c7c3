"""Distinct counts from bitmaps against `countDistinct`."""

import random

from pyspark.sql import functions as F

from cohortlens.operators import distinct


def frame(spark, seed, n, values):
    rng = random.Random(seed)
    data = [(f"f{rng.randint(0, 4)}", rng.choice([None, f"v{rng.randint(0, values)}"])) for _ in range(n)]
    return spark.createDataFrame(data, "file string, code string")


def test_partials_merge_in_any_order(spark, rows):
    a, b = frame(spark, 1, 600, 200), frame(spark, 2, 600, 300)
    first = distinct.dictionary(a, "code").cache()
    both = distinct.dictionary(b, "code", first).cache()
    # Numbers stay, new ones are new.
    assert set(rows(first)) <= set(rows(both)) and both.select("number").distinct().count() == both.count()
    pa, pb = distinct.partials(a, "code", first, ["file"]), distinct.partials(b, "code", both, ["file"])
    whole = a.unionByName(b)
    want = rows(whole.groupBy("file").agg(F.countDistinct("code")))
    assert rows(distinct.counted(pa.unionByName(pb), ["file"])) == want
    assert rows(distinct.counted(pb.unionByName(pa).unionByName(pa), ["file"])) == want
    total = whole.agg(F.countDistinct("code")).first()[0]
    assert distinct.counted(distinct.merged(pa).unionByName(distinct.merged(pb))).first()[0] == total


def test_many_values_and_none(spark):
    df = spark.range(100_000).select(F.col("id").cast("string").alias("v"))
    numbers = distinct.dictionary(df, "v").cache()
    parts = distinct.partials(df.unionByName(df), "v", numbers)
    assert parts.count() > 1 and distinct.counted(parts).first()[0] == 100_000
    assert numbers.agg(F.max("number")).first()[0] < 130_000
    none = distinct.partials(df.limit(0), "v", numbers)
    assert distinct.counted(none).first()[0] == 0
