"""The whole analysis: export tables, SQL views over them, and the report queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..scale import stage
from ..schemas import GPA_METRICS, STAT_METRICS
from ..sources.files import read_partitioned
from ..sources.tables import export_plan_rows, export_result, export_sections
from ..sources.versions import TableSet
from .association import mixed_associations, phik_pairs, rounded, spearman_pairs, top_pairs
from .choice import compare_with_baseline, optimize_plans
from .courses import (
    course_sums, easiest_courses, gpa_of_sums, hardest_courses, instructor_report, kpi_summary, stats_of_sums, yearly_trend,
)
from .matching import attach_metrics
from .rollup import difficulty_score, major_expected_gpa, major_rates, ranked
from .sections import for_correlation

# Report queries over the views of `register_views`.
REPORTS = {
    "expected_gpa": """
        SELECT major, expected_gpa, coverage_pct, matched_credit_hours
        FROM major_expected_gpa ORDER BY expected_gpa DESC NULLS LAST, major""",
    "optimizer_comparison": """
        SELECT major, baseline_expected_gpa, optimal_expected_gpa, gpa_uplift, num_choice_groups
        FROM optimizer_comparison ORDER BY optimal_expected_gpa DESC, major""",
    "optimizer_selections": """
        SELECT major, course_subject, course_number, title, mean_gpa
        FROM optimizer_selections ORDER BY major, choice_group_id""",
    "difficulty_index": """
        SELECT major, expected_gpa, avg_fail_rate, avg_drop_rate, difficulty_score
        FROM major_difficulty_index ORDER BY difficulty_score DESC NULLS LAST, major""",
}
# Reports that are computed from the section view when asked for.
LIVE = {"kpis": kpi_summary, "hardest_courses": hardest_courses, "easiest_courses": easiest_courses, "yearly_trend": yearly_trend}

RESULTS = ["major_expected_gpa", "optimizer_comparison", "optimizer_selections", "major_difficulty_index"]


def analyse(
    plan: DataFrame, sections: DataFrame, aliases: dict[str, list[str]] | None = None
) -> dict[str, DataFrame]:
    """Ranking, comparison, selections and difficulty index."""
    # One pass over the sections serves both course tables.
    sums = stage(course_sums(sections)).df
    matched = stage(attach_metrics(plan, gpa_of_sums(sums), GPA_METRICS, aliases)).df
    rated = attach_metrics(plan, stats_of_sums(sums), STAT_METRICS, aliases)
    ranking = ranked(major_expected_gpa(matched))
    summary, selections = optimize_plans(matched)
    return {
        "major_expected_gpa": ranking,
        "optimizer_comparison": compare_with_baseline(summary, ranking),
        "optimizer_selections": selections,
        "major_difficulty_index": difficulty_score(stage(major_rates(rated)).df),
    }


def export_all(
    plan: DataFrame, sections: DataFrame, folder: str, aliases: dict[str, list[str]] | None = None
) -> None:
    """Write sections, plan rows and the four results below `folder`."""
    # Both are read several times.
    sections, plan = stage(sections).df, stage(plan).df
    export_sections(sections, f"{folder}/grade_distributions")
    export_plan_rows(plan, f"{folder}/degree_plan_courses")
    for name, result in analyse(plan, sections, aliases).items():
        export_result(result, f"{folder}/{name}.parquet")


def correlation_report(
    sections: DataFrame, numeric: list[str], nominal: list[str]
) -> dict[str, DataFrame]:
    """Rank correlations, strongest pairs, associations and instructor aggregates."""
    prepared = for_correlation(sections)
    # Every table of the report reads the rows, some more than once: they are derived once.
    used = {*numeric, *nominal, "Instructor", "GPA", "Total", "Pct_A", "Class_Size"}
    prepared = stage(prepared.select(*(f"`{c}`" for c in prepared.columns if c in used))).df
    ranks = rounded(spearman_pairs(prepared, numeric))
    return {
        "spearman": ranks,
        "top_pairs": top_pairs(ranks),
        "phik": rounded(phik_pairs(prepared, nominal, numeric)),
        "associations": mixed_associations(prepared, nominal, numeric),
        "instructors": instructor_report(prepared),
    }


def register_views(spark: SparkSession, folder: str, sections_schema, plan_schema) -> None:
    """Temporary views over the tables `export_all` wrote."""
    frames = {
        "grade_distributions": read_partitioned(spark, f"{folder}/grade_distributions", sections_schema),
        "degree_plan_courses": read_partitioned(spark, f"{folder}/degree_plan_courses", plan_schema),
    }
    for name in RESULTS:
        frames[name] = spark.read.parquet(f"{folder}/{name}.parquet")
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def create_tables(spark: SparkSession, schema: str, frames: dict[str, DataFrame]) -> None:
    """Create a schema if needed and replace its tables, all of them or none.

    The rows of all tables are written first, below `<schema location>/_sets`. The
    tables of the catalog are views over the version that this makes; readers
    that resolve the set itself (`published`) never see a mix.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    store = published(spark, schema)
    version = store.replace(frames)
    for name in frames:
        full = f"{schema}.{name}"
        if spark.catalog.tableExists(full) and spark.catalog.getTable(full).tableType != "VIEW":
            spark.sql(f"DROP TABLE {full}")
        source = " UNION ALL ".join(f"SELECT * FROM parquet.`{f}`" for f in store.folders(name, version))
        spark.sql(f"CREATE OR REPLACE VIEW {full} AS {source}")


def published(spark: SparkSession, schema: str) -> TableSet:
    """The set of tables of a schema as `create_tables` keeps it."""
    return TableSet(spark, f"{spark.catalog.getDatabase(schema).locationUri}/_sets")


def report(spark: SparkSession, name: str) -> DataFrame:
    """One of `REPORTS` or `LIVE` over the registered views."""
    return LIVE[name](spark.table("grade_distributions")) if name in LIVE else spark.sql(REPORTS[name])
