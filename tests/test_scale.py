"""Prefix sums over ranges, and staged tables that go when their owner is done."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from cohortlens.scale import running_totals, stage, workspace


@pytest.mark.parametrize("range_rows", [10, 1_000_000])
def test_running_totals(spark, rows, range_rows):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"), (F.col("id") * 7 % 3001).cast("double").alias("o"), (F.col("id") % 5).alias("n")
    )
    table = stage(df)
    assert table.rows == 3000
    before = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    direct = df.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    ranged = running_totals(table, ["g"], "o", "n", "before", range_rows=range_rows)
    assert rows(direct) == rows(ranged.select(*direct.columns))


def test_stage_of_nothing(spark):
    table = stage(spark.range(5).where("id > 9"))
    assert table.rows == 0 and table.df.count() == 0


def test_a_workspace_deletes_what_was_staged_inside(spark):
    with workspace(spark) as folder:
        assert stage(spark.range(5)).df.count() == 5
        assert os.listdir(folder)
    assert not os.path.exists(folder)
