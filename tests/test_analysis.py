"""Course statistics, matching, rollups and scores on hand-computed cases."""

import pytest

from cohortlens import schemas
from cohortlens.operators import courses, matching, rollup

SECTION = "Class_Code string, GPA double, F bigint, Total_A_F bigint, Q bigint, X bigint, Total bigint"
PLAN = (
    "major string, row_type string, choice_group_id bigint, course_subject string, course_number string,"
    " title string, credit_hours double"
)
MATCHED = PLAN + ", mean_gpa double, fail_rate double, drop_rate double"


def unit(row_type, gid, hours, gpa=None, fail=None, drop=None, major="M", subject="S", number="1"):
    return (major, row_type, gid, subject, number, "t", hours, gpa, fail, drop)


def test_weighted_stats(spark):
    s = spark.createDataFrame(
        [("a-1", 3.0, 1, 10, 0, 0, 10), ("A-1", None, 0, 0, 2, 1, 5), ("A-1", 2.0, None, 0, 0, 0, 0), ("NODASH", 4.0, 0, 1, 0, 0, 1)],
        SECTION,
    )
    stats = courses.course_stats(s).collect()
    assert [tuple(r) for r in stats] == [("A", "1", 3.0, 0.1, 0.2, 15)]
    assert [tuple(r) for r in courses.course_gpa(s).collect()] == [("A", "1", 3.0, 10)]
    assert courses.course_gpa(s.drop("Total")).orderBy("course_subject").first().n_students == 2


def test_missing_columns_give_typed_empty_frames(spark):
    s = spark.createDataFrame([("x",)], "other string")
    assert courses.course_gpa(s).schema == schemas.COURSE_GPA and courses.course_gpa(s).isEmpty()
    assert courses.course_stats(s).schema == schemas.COURSE_STATS


def test_alias_fallback(spark, rows):
    stats = spark.createDataFrame(
        [
            ("PSYC", "1", 3.0, 0.1, 0.2, 10), ("PBSI", "2", 2.0, 0.3, 0.4, 20), ("PBSI", "3", None, 0.5, 0.6, 30),
            ("PSYC", "2", 1.0, 0.0, 0.0, 99), ("MATH", "1", 2.5, 0.0, 0.0, 7),
        ],
        schemas.COURSE_STATS,
    )
    plan = spark.createDataFrame(
        [("M", "course", None, s, n, "t", 3.0) for s, n in [("PBSI", "1"), ("PBSI", "2"), ("PBSI", "3"), ("MATH", "1"), ("PSYC", "9")]]
        + [("M", "requirement_block", 1, None, None, "t", 3.0)],
        PLAN,
    )
    out = matching.attach_metrics(plan, stats, schemas.STAT_METRICS)
    got = {(r.course_subject, r.course_number): (r.mean_gpa, r.fail_rate, r.drop_rate, r.n_students) for r in out.collect()}
    none = (None,) * 4
    assert got == {
        ("PBSI", "1"): (3.0, 0.1, 0.2, 10), ("PBSI", "2"): (2.0, 0.3, 0.4, 20), ("PBSI", "3"): none,
        ("MATH", "1"): (2.5, 0.0, 0.0, 7), ("PSYC", "9"): none, (None, None): none,
    }


def test_alias_priority(spark):
    stats = spark.createDataFrame(
        [("OLD1", "1", 1.0, 0.0, 0.0, 1), ("OLD2", "1", 2.0, 0.0, 0.0, 2), ("OLD2", "2", 3.0, 0.0, 0.0, 3)], schemas.COURSE_STATS
    )
    out = matching.with_aliases(stats, ["mean_gpa"], {"NEW": ["OLD1", "OLD2"]}).where("course_subject = 'NEW'")
    assert {(r.course_number, r.mean_gpa) for r in out.collect()} == {("1", 1.0), ("2", 3.0)}


CASE = [
    unit("course", None, 3.0, 3.0), unit("course", None, 4.0), unit("choice_header", 1, 2.0),
    unit("choice_option", 1, None, 2.0), unit("choice_option", 1, None, 4.0), unit("choice_option", 1, None),
    unit("requirement_block", 2, 3.0), unit("term_subtotal", None, 9.0),
]


def test_expected_gpa(spark):
    df = spark.createDataFrame([*CASE, unit("requirement_block", 1, 3.0, major="EMPTY")], MATCHED)
    out = {r.major: tuple(r)[1:] for r in rollup.major_expected_gpa(df).collect()}
    assert out["M"] == (3.0, 5.0, 9.0, 55.6)
    assert out["EMPTY"] == (None, 0.0, 0.0, 0.0)


def test_scope_reset_rows_do_not_meet(spark):
    df = spark.createDataFrame([unit("choice_header", None, 2.0), unit("choice_option", None, None, 4.0)], MATCHED)
    assert tuple(rollup.major_expected_gpa(df).first())[1:] == (None, 0.0, 2.0, 0.0)


def test_rates_skip_nulls(spark):
    df = spark.createDataFrame(
        [unit("course", None, 3.0, 3.0, None, 0.3), unit("choice_header", 1, 1.0), unit("choice_option", 1, None, 2.0, 0.2, 0.1),
         unit("choice_option", 1, None, 4.0, None, 0.3), unit("course", None, None, 1.0, 0.9, 0.9)],
        MATCHED,
    )
    r = rollup.major_rates(df).first()
    assert (r.expected_gpa, r.matched_credit_hours) == (3.0, 4.0)
    assert r.avg_fail_rate == pytest.approx(0.05) and r.avg_drop_rate == pytest.approx((0.9 + 0.2) / 4)


RATES = "major string, expected_gpa double, avg_fail_rate double, avg_drop_rate double, matched_credit_hours double"


@pytest.mark.parametrize(
    "data, expected",
    [
        ([("a", 2.0, 0.2, 0.2, 1.0), ("b", 3.0, 0.1, 0.1, 1.0)], {"a": 100.0, "b": 0.0}),
        ([("a", 2.0, 0.2, 0.2, 1.0), ("b", 2.0, 0.2, 0.2, 1.0)], {"a": 50.0, "b": 50.0}),
        ([("a", 2.0, 0.2, 0.2, 1.0), ("b", None, None, None, 0.0)], {"a": None, "b": None}),
        ([("a", 2.0, 0.2, 0.2, 1.0), ("b", 3.0, 0.1, 0.1, 1.0), ("c", None, 0.0, 0.0, 0.0)], {"a": 100.0, "b": 0.0, "c": None}),
    ],
)
def test_score(spark, data, expected):
    out = rollup.difficulty_score(spark.createDataFrame(data, RATES))
    assert {r.major: r.difficulty_score for r in out.collect()} == expected
