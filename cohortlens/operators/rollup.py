"""Roll matched plan rows up per major: expectation, coverage, difficulty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..codes import COURSE, HEADER, OPTION
from ..functions.numbers import half_even, ratio
from ..schemas import GPA_METRICS, STAT_METRICS
from ..scale import stage
from .courses import course_gpa, course_stats
from .matching import attach_metrics


def _hours() -> Column:
    return F.coalesce(F.col("credit_hours"), F.lit(0.0))


def _is(row_type: str) -> Column:
    return F.col("row_type") == row_type


def choice_group_means(matched: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Per choice group: mean metrics over the options with a GPA, null if none has one."""
    options = matched.where(_is(OPTION) & F.col("choice_group_id").isNotNull())
    has_gpa = F.col("mean_gpa").isNotNull()
    return options.groupBy("major", "choice_group_id").agg(
        *[F.avg(F.when(has_gpa, F.col(m))).alias(m) for m in metrics or ["mean_gpa"]],
        F.count("*").alias("n_options"),
        F.count("mean_gpa").alias("n_matched"),
    )


def _units(matched: DataFrame, metrics: list[str]) -> DataFrame:
    """One row per (major, choice group): hours and hour-weighted metrics of its units.

    A choice header and its options meet in one aggregate, so no join is needed
    and a group of any size is reduced before the shuffle. Courses are summed in
    the same pass. Rows without a group have no options to meet.
    """
    has_gpa = F.col("mean_gpa").isNotNull()
    taken = _is(COURSE) & has_gpa
    h = _hours()

    def weighted(m: str) -> Column:
        return F.sum(F.when(taken, F.coalesce(F.col(m), F.lit(0.0)) * h))

    per_group = (
        matched.where("major IS NOT NULL")
        .groupBy("major", "choice_group_id")
        .agg(
            F.sum(F.when(_is(COURSE), h)).alias("course_hours"),
            F.sum(F.when(taken, h)).alias("course_matched"),
            *[weighted(m).alias(f"course_{m}") for m in metrics],
            F.sum(F.when(_is(HEADER), h)).alias("header_hours"),
            *[F.avg(F.when(_is(OPTION) & has_gpa, F.col(m))).alias(f"option_{m}") for m in metrics],
        )
    )
    grouped = F.col("choice_group_id").isNotNull() & F.col("option_mean_gpa").isNotNull()
    zero = F.lit(0.0)
    head = F.coalesce("header_hours", zero)
    return per_group.select(
        "major",
        (F.coalesce("course_hours", zero) + head).alias("hours"),
        (F.coalesce("course_matched", zero) + F.when(grouped, head).otherwise(zero)).alias("matched"),
        *[
            (
                F.coalesce(f"course_{m}", zero)
                + F.when(grouped, F.coalesce(f"option_{m}", zero) * head).otherwise(zero)
            ).alias(m)
            for m in metrics
        ],
    )


def major_expected_gpa(matched: DataFrame) -> DataFrame:
    """Credit-weighted expected GPA and coverage per major.

    Units are required courses and choice groups (hours of the header, mean of
    the options). Requirement blocks and totals do not count.
    """
    total = _units(matched, ["mean_gpa"]).groupBy("major").agg(
        F.sum("mean_gpa").alias("w"), F.sum("matched").alias("m"), F.sum("hours").alias("t")
    )
    return total.select(
        "major",
        ratio("w", "m").alias("expected_gpa"),
        F.col("m").alias("matched_credit_hours"),
        F.col("t").alias("total_course_credit_hours"),
        half_even(F.coalesce(ratio("m", "t"), F.lit(0.0)) * 100, 1).alias("coverage_pct"),
    )


def ranked(majors: DataFrame) -> DataFrame:
    return majors.orderBy(F.desc_nulls_last("expected_gpa"), "major")


def rank_majors(
    plan: DataFrame, sections: DataFrame, aliases: dict[str, list[str]] | None = None
) -> DataFrame:
    """Plan rows and sections to majors ranked by expected GPA."""
    matched = attach_metrics(plan, course_gpa(sections), GPA_METRICS, aliases)
    return ranked(major_expected_gpa(matched))


def low_coverage(majors: DataFrame, below: float = 50.0) -> DataFrame:
    return majors.where(F.col("coverage_pct") < below)


def major_rates(matched: DataFrame) -> DataFrame:
    """Credit-weighted GPA, failure and drop rate per major; null without matched hours."""
    total = _units(matched, ["mean_gpa", "fail_rate", "drop_rate"]).groupBy("major").agg(
        *[F.sum(c).alias(c) for c in ["mean_gpa", "fail_rate", "drop_rate", "matched"]]
    )
    return total.select(
        "major",
        ratio("mean_gpa", "matched").alias("expected_gpa"),
        ratio("fail_rate", "matched").alias("avg_fail_rate"),
        ratio("drop_rate", "matched").alias("avg_drop_rate"),
        F.col("matched").alias("matched_credit_hours"),
    )


def difficulty_score(rates: DataFrame) -> DataFrame:
    """Add a 0-100 score: z(-GPA) + z(failure) + z(drop), rescaled over the majors.

    `rates` is a staged table. The moments and the span are one-row aggregates
    read as scalars, so no window spans all majors.
    """
    metrics = ["expected_gpa", "avg_fail_rate", "avg_drop_rate"]
    complete = rates.na.drop(subset=metrics)
    moments = complete.agg(
        F.struct(
            F.count("*").alias("n"),
            *[F.avg(m).alias(f"mean_{m}") for m in metrics],
            # The float deviation of equal values need not be exactly zero.
            *[F.when(F.min(m) < F.max(m), F.stddev_pop(m)).otherwise(0.0).alias(f"std_{m}") for m in metrics],
        ).alias("m")
    ).scalar()

    def z(m: str) -> Column:
        std = F.col(f"m.std_{m}")
        return F.when(std > 0, (F.col(m) - F.col(f"m.mean_{m}")) / F.nullif(std, F.lit(0.0))).otherwise(0.0)

    raw = F.when(
        F.expr(" AND ".join(f"{m} IS NOT NULL" for m in metrics)) & (F.col("m.n") > 1),
        z("avg_fail_rate") + z("avg_drop_rate") - z("expected_gpa"),
    )
    scored = rates.withColumn("m", moments).withColumn("raw", raw).drop("m")
    span = scored.agg(F.struct(F.min("raw").alias("lo"), F.max("raw").alias("hi")).alias("s")).scalar()
    width = F.col("s.hi") - F.col("s.lo")
    rescaled = F.when(width > 0, (F.col("raw") - F.col("s.lo")) / F.nullif(width, F.lit(0.0)) * 100).otherwise(50.0)
    return (
        scored.withColumn("s", span)
        .withColumn("difficulty_score", F.when(F.col("raw").isNotNull(), rescaled))
        .drop("raw", "s")
        .orderBy(F.desc_nulls_last("difficulty_score"), "major")
    )


def difficulty_index(
    plan: DataFrame, sections: DataFrame, aliases: dict[str, list[str]] | None = None
) -> DataFrame:
    """Plan rows and sections to majors with rates and a relative difficulty score."""
    matched = attach_metrics(plan, course_stats(sections), STAT_METRICS, aliases)
    return difficulty_score(stage(major_rates(matched)).df)
