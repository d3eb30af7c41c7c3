"""Moments of all pairs of columns against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.operators import association as A
from cohortlens.operators import gram


def table(rows, columns, seed, missing):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rows, columns)) + rng.normal(size=(rows, 1)) * (np.arange(columns) % 3)
    x[rng.random(x.shape) < missing] = np.nan
    return pd.DataFrame(x, columns=[f"v{i}" for i in range(columns)])


def frame(spark, pdf, parts=4):
    clean = pdf.astype(object).where(pdf.notna(), None)
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in pdf.columns])
    return spark.createDataFrame(list(clean.itertuples(index=False, name=None)), schema).repartition(parts)


def compare(df, pdf):
    wanted, names = pdf.corr().to_numpy(), list(pdf.columns)
    found = df.collect()
    assert len(found) == len(names) * (len(names) - 1) // 2
    place = {c: i for i, c in enumerate(names)}
    for r in found:
        value = wanted[place[r.col_a], place[r.col_b]]
        assert (r.r is None) == bool(np.isnan(value)), r
        if r.r is not None:
            assert r.r == pytest.approx(value, abs=1e-9), r
        both = int((pdf[r.col_a].notna() & pdf[r.col_b].notna()).sum())
        assert (r.n or 0) == both


def test_200_columns_in_one_scan(spark):
    pdf = table(300, 200, 1, 0.2)
    df = frame(spark, pdf)
    compare(A.pearson_pairs(df), pdf)


@pytest.mark.parametrize("stripe", [1, 3, 5, 100])
def test_stripes(spark, monkeypatch, stripe):
    monkeypatch.setattr(gram, "STRIPE", stripe)
    pdf = table(80, 7, stripe, 0.3)
    compare(A.pearson_pairs(frame(spark, pdf)), pdf)


def test_values_far_from_zero_and_from_task_to_task(spark):
    pdf = table(400, 3, 5, 0.1)
    pdf += 1e9
    df = spark.createDataFrame(pdf).select(*[F.nanvl(c, F.lit(None)).alias(c) for c in pdf.columns])
    df = df.repartitionByRange(5, "v0")
    wanted = (pdf - 1e9).corr().to_numpy()
    for r in A.pearson_pairs(df).collect():
        assert r.r == pytest.approx(wanted[int(r.col_a[1]), int(r.col_b[1])], abs=1e-6)


def test_constant_only_where_the_other_is_set(spark):
    rows = [(0.1, None, 1.0), (0.7, None, 2.0), (0.3, 1.0, 3.0), (0.3, 2.0, 5.0), (0.3, 4.0, None), (float("nan"), 9.0, 1.0)]
    found = {(r.col_a, r.col_b): (r.r, r.n) for r in A.pearson_pairs(spark.createDataFrame(rows, "a double, b double, c double")).collect()}
    assert found["a", "b"] == (None, 3)
    assert found["a", "c"][0] is not None and found["a", "c"][1] == 4
    assert found["b", "c"][1] == 3


def test_no_rows_no_columns_no_values(spark):
    empty = spark.createDataFrame([], "a double, b int, c double")
    assert [(r.r, r.n) for r in A.pearson_pairs(empty).collect()] == [(None, None)] * 3
    assert A.pearson_pairs(empty, ["a"]).collect() == []
    nulls = spark.createDataFrame([(None, 1, 2.0)] * 3, "a double, b int, c double")
    assert {(r.col_a, r.col_b): r.n for r in A.pearson_pairs(nulls).collect()} == {("a", "b"): None, ("a", "c"): None, ("b", "c"): 3}


def test_rows_are_not_repeated_per_pair(spark):
    df = frame(spark, table(20, 12, 3, 0.1))
    read = gram._partials(df, df.columns, list(range(12)), [(0, 1), (4, 9)])
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Generate" not in plan
