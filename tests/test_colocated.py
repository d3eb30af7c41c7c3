"""Kept tables match as a join does, and their join has no exchange."""

import pytest
from test_analysis import PLAN, unit

from cohortlens.operators import matching
from cohortlens.sources import colocated

METRICS = "course_subject string, course_number string, mean_gpa double, n_students bigint"
NAMES = ["mean_gpa", "n_students"]


@pytest.fixture
def tables(spark):
    names = ("kept_plan", "kept_metrics")
    yield names
    colocated.forget(spark, *names)


def test_no_exchange_and_the_same_rows(spark, rows, tables):
    data = [unit("course", None, 3.0, major=f"M{i % 40}", subject="HOT", number="1")[:7] for i in range(200)]
    data += [unit("course", None, 3.0, major=f"M{i}", subject=f"S{i % 7}", number=str(i % 3))[:7] for i in range(60)]
    data += [unit("choice_header", i, 2.0, subject=None, number=None)[:7] for i in range(20)]
    data += [unit("course", None, 1.0, subject="PSYC", number="5")[:7], unit("course", None, 1.0, subject="S1", number=None)[:7]]
    plan = spark.createDataFrame(data, PLAN)
    stats = spark.createDataFrame(
        [("HOT", "1", 3.5, 10), ("PBSI", "5", 2.0, 4), ("S1", "1", None, None), (None, "1", 1.0, 1)]
        + [(f"S{i}", "0", i / 2, i) for i in range(7)], METRICS)
    aliases = {"PSYC": ["PBSI"]}
    colocated.keep_plan(plan, tables[0], buckets=6)
    colocated.keep_metrics(stats, tables[1], NAMES, aliases, buckets=6)
    got = colocated.match_kept(spark, *tables, NAMES)
    assert rows(got) == rows(matching.attach_metrics(plan, stats, NAMES, aliases))
    physical = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in physical and "Exchange" not in physical
    # The hot course lies in several buckets, each bucket in one file.
    files = spark.table(tables[0]).where("course_subject = 'HOT'").selectExpr("_metadata.file_name AS f").distinct().count()
    assert files > 1 and len(spark.table(tables[0]).inputFiles()) <= 6


def test_kept_tables_are_replaced(spark, rows, tables):
    plan = spark.createDataFrame([unit("course", None, 3.0)[:7]], PLAN)
    stats = spark.createDataFrame([("S", "1", 3.0, 5)], METRICS)
    colocated.keep_plan(plan.limit(0), tables[0])
    colocated.keep_metrics(stats, tables[1], NAMES, {})
    assert colocated.match_kept(spark, *tables, NAMES).count() == 0
    colocated.keep_plan(plan, tables[0])
    assert [r.mean_gpa for r in colocated.match_kept(spark, *tables, NAMES).collect()] == [3.0]
