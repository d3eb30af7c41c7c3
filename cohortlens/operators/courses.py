"""Per-course statistics: one aggregate serves the ranking, the index and the optimiser."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import half_up, ratio
from ..functions.text import split_first_dash
from ..schemas import COURSE_GPA, COURSE_KEY, COURSE_STATS
from .sections import typed

REQUIRED_FOR_GPA = {"Class_Code", "GPA"}
REQUIRED_FOR_STATS = {"Class_Code", "GPA", "F", "Total_A_F", "Q", "X", "Total"}


def with_course_key(sections: DataFrame) -> DataFrame:
    """Add `course_subject` and `course_number`, cut at the first dash of `Class_Code`."""
    subject, num = split_first_dash("Class_Code")
    return sections.withColumns({"course_subject": subject, "course_number": num})


def _has(df: DataFrame, required: set[str]) -> bool:
    return required <= set(df.columns)


def _empty(df: DataFrame, schema) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def course_sums(sections: DataFrame) -> DataFrame:
    """Sums per course over sections with students: what both course tables are made of."""
    rows = with_course_key(typed(sections)).where(
        "course_subject IS NOT NULL AND course_number IS NOT NULL AND Total > 0"
    )
    graded = F.col("GPA").isNotNull()

    def total(c: str | Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    return rows.groupBy(*COURSE_KEY).agg(
        F.sum(F.col("GPA") * F.col("Total")).alias("points"),
        total(F.when(graded, F.col("Total"))).cast("bigint").alias("graded"),
        total("F").alias("failed"), total("Total_A_F").alias("rated"),
        (total("Q") + total("X")).alias("dropped"),
        F.sum("Total").cast("bigint").alias("n_students"),
    )


def gpa_of_sums(sums: DataFrame) -> DataFrame:
    """Weighted mean GPA per course; `n_students` counts GPA-bearing sections only."""
    return sums.where("graded > 0").select(
        *COURSE_KEY, (F.col("points") / F.col("graded")).alias("mean_gpa"), F.col("graded").alias("n_students")
    )


def stats_of_sums(sums: DataFrame) -> DataFrame:
    """Weighted GPA, failure and drop rate per course."""
    return sums.select(
        *COURSE_KEY, ratio("points", "graded").alias("mean_gpa"), ratio("failed", "rated").alias("fail_rate"),
        ratio("dropped", "n_students").alias("drop_rate"), "n_students",
    )


def course_gpa(sections: DataFrame) -> DataFrame:
    """Weighted mean GPA per course; the weight is `Total`, or 1 per section if there is no such column."""
    if not _has(sections, REQUIRED_FOR_GPA):
        return _empty(sections, COURSE_GPA)
    if "Total" not in sections.columns:
        sections = sections.withColumn("Total", F.lit(1).cast("bigint"))
    for c in REQUIRED_FOR_STATS - set(sections.columns):
        sections = sections.withColumn(c, F.lit(0).cast("bigint"))
    return gpa_of_sums(course_sums(sections))


def course_stats(sections: DataFrame) -> DataFrame:
    """Weighted GPA, failure and drop rate per course over sections with students."""
    if not _has(sections, REQUIRED_FOR_STATS):
        return _empty(sections, COURSE_STATS)
    return stats_of_sums(course_sums(sections))


def weighted_courses(sections: DataFrame, min_students: int = 200) -> DataFrame:
    """Weighted GPA (two digits) of courses with at least `min_students` students."""
    return (
        sections.where("GPA IS NOT NULL AND Total IS NOT NULL")
        .groupBy(F.col("Class_Code").alias("class_code"))
        .agg(
            half_up(ratio(F.sum(F.col("GPA") * F.col("Total")), F.sum("Total")), 2).alias("weighted_gpa"),
            F.sum("Total").cast("bigint").alias("n_students"),
        )
        .where(F.col("n_students") >= min_students)
    )


def hardest_courses(sections: DataFrame, n: int = 10, min_students: int = 200) -> DataFrame:
    return weighted_courses(sections, min_students).orderBy("weighted_gpa", "class_code").limit(n)


def easiest_courses(sections: DataFrame, n: int = 10, min_students: int = 200) -> DataFrame:
    return (
        weighted_courses(sections, min_students)
        .orderBy(F.desc("weighted_gpa"), "class_code")
        .limit(n)
    )


def kpi_summary(sections: DataFrame) -> DataFrame:
    """Rows, students, distinct courses and the span of years, where the year is a number."""
    year = F.col("Year").try_cast("int")
    return sections.where(year.isNotNull()).agg(
        F.count("*").alias("total_grade_rows"),
        F.sum("Total").cast("bigint").alias("total_students_graded"),
        F.countDistinct("Class_Code").alias("distinct_courses"),
        F.min(year).alias("earliest_year"),
        F.max(year).alias("latest_year"),
    )


def yearly_trend(sections: DataFrame) -> DataFrame:
    """Weighted GPA (three digits) per year, in order of years."""
    year = F.col("Year").try_cast("int")
    return (
        sections.where(F.col("GPA").isNotNull() & F.col("Total").isNotNull() & year.isNotNull())
        .groupBy(year.alias("Year"))
        .agg(half_up(ratio(F.sum(F.col("GPA") * F.col("Total")), F.sum("Total")), 3).alias("weighted_gpa"))
        .orderBy("Year")
    )


def instructor_report(prepared: DataFrame, n: int = 20) -> DataFrame:
    """Top instructors by mean GPA; means are per section and skip nulls.

    `prepared` comes from `sections.for_correlation`.
    """

    def mean(c: str) -> Column:
        # Half to even on the value without its float noise.
        return F.bround(F.avg(c).cast("decimal(28,9)"), 2).cast("double")

    return (
        prepared.where("Instructor IS NOT NULL")
        .groupBy("Instructor")
        .agg(
            mean("GPA").alias("GPA_mean"),
            F.count("GPA").alias("GPA_count"),
            F.coalesce(F.sum("Total"), F.lit(0)).cast("bigint").alias("Total_sum"),
            mean("Pct_A").alias("Pct_A_mean"),
            mean("Class_Size").alias("Class_Size_mean"),
        )
        .orderBy(F.desc_nulls_last("GPA_mean"), "Instructor")
        .limit(n)
    )
