"""Registered queries: name -> function of (session, data folder)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bridge
from .codes import NOISE_KEYWORDS
from .functions.numbers import half_up
from .functions.text import slug
from .operators import association, choice, courses, grid, matching, reports, rollup, worklist
from .operators import sections as sec
from .plans import documents, outline
from .scale import shared_folder, stage
from .schemas import COURSE_KEY, GPA_METRICS, PARTITION_COLUMNS, STAT_METRICS
from .sources import files, tables
from .streaming import ingest

NUMERIC = ["Year", "A", "F", "Total_A_F", "GPA", "Q", "X", "Total", "Pct_A", "Pct_graded", "Class_Size"]
NOMINAL = ["College", "Semester", "Instructor"]
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _digits(df: DataFrame, n: int = 6) -> DataFrame:
    """Round doubles so that the order of float sums does not show."""
    new = {f.name: half_up(F.col(f.name), n) for f in df.schema if isinstance(f.dataType, T.DoubleType)}
    return df.withColumns(new) if new else df


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = courses.course_gpa(bridge.sections(spark, sf_dir))
    return matching.attach_metrics(bridge.plan_rows(spark, sf_dir), stats, GPA_METRICS, bridge.ALIASES)


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sec.for_correlation(bridge.sections(spark, sf_dir))


# Sections: cleanup and metadata


@query
def section_split(spark, sf_dir):
    raw = bridge.raw_sections(spark, sf_dir).select("source_file", "Section")
    return sec.sql_names(sec.split_section(raw))


@query
def numeric_coercion(spark, sf_dir):
    columns = ["Section", *NUMERIC]
    return _digits(_prepared(spark, sf_dir).select(*columns))


@query
def int_conversion(spark, sf_dir):
    raw = bridge.raw_sections(spark, sf_dir).select("total_comma_raw", "GPA", "Section")
    return grid.to_whole_numbers(raw, ["total_comma_raw", "GPA", "Section"], fill=-1)


@query
def keyword_filter(spark, sf_dir):
    raw = sec.sql_names(bridge.raw_sections(spark, sf_dir)).drop("total_comma_raw")
    return grid.drop_keyword_rows(raw, [*NOISE_KEYWORDS, "promo-1", "--"])


@query
def grid_trim_pad(spark, sf_dir):
    rows = grid.trim_and_pad(bridge.raw_grid(spark, sf_dir))
    named = grid.name_columns(rows, ["c0", "c1"], width=4)
    return named.withColumn("n_cells", F.lit(4)).drop("row_idx")


@query
def grid_rows(spark, sf_dir):
    raw = bridge.raw_grid(spark, sf_dir)
    return grid.grid_to_rows(raw, width=4).drop("row_idx")


@query
def file_metadata(spark, sf_dir):
    name = F.col("source_file")
    # Some files get a known code, a code with an underscore, or a wrong prefix.
    for old, new in (("AFRICA", "en"), ("ASIA", "md_prof"), ("AMERICA", "zz_q")):
        name = F.replace(name, F.lit(old), F.lit(new))
    name = F.when(F.contains(name, F.lit("EUROPE")), F.replace(name, F.lit("grd_"), F.lit("gpac_"))).otherwise(name)
    raw = bridge.raw_sections(spark, sf_dir).select(name.alias("source_file"))
    return sec.add_file_fields(raw.groupBy("source_file").agg(F.count("*").alias("n_rows")))


@query
def header_row(spark, sf_dir):
    supplier = bridge.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return grid.header_as_first_row(supplier, order="s_suppkey")


@query
def aligned_append(spark, sf_dir):
    s = bridge.sections(spark, sf_dir)
    first = s.where("Total >= 25").select("Class_Code", "Total", "GPA")
    second = s.where("Total < 25").select("Instructor", "Total", "Class_Code")
    return tables.union_aligned(first, second)


@query
def group_rollup(spark, sf_dir):
    groups = {"SOUTH": ["AFRICA", "AMERICA"], "EAST": ["ASIA", "MIDDLE_EAST"], "WIDE": ["ASIA", "AFRICA"]}
    return sec.college_group_totals(bridge.sections(spark, sf_dir), groups)


# Courses and reports


@query
def kpi_summary(spark, sf_dir):
    return courses.kpi_summary(bridge.sections(spark, sf_dir))


@query
def hardest_courses(spark, sf_dir):
    return courses.hardest_courses(bridge.sections(spark, sf_dir))


@query
def easiest_courses(spark, sf_dir):
    return courses.easiest_courses(bridge.sections(spark, sf_dir))


@query
def yearly_trend(spark, sf_dir):
    return courses.yearly_trend(bridge.sections(spark, sf_dir))


@query
def course_gpa(spark, sf_dir):
    return _digits(courses.course_gpa(bridge.sections(spark, sf_dir)))


@query
def course_stats(spark, sf_dir):
    return _digits(courses.course_stats(bridge.sections(spark, sf_dir)))


@query
def instructor_report(spark, sf_dir):
    return courses.instructor_report(_prepared(spark, sf_dir))


@query
def course_tables(spark, sf_dir):
    sums = stage(courses.course_sums(bridge.sections(spark, sf_dir))).df
    gpa = courses.gpa_of_sums(sums).withColumnsRenamed({"mean_gpa": "gpa", "n_students": "graded"})
    return _digits(courses.stats_of_sums(sums).join(gpa, COURSE_KEY, "left"))


# Plans against courses


@query
def plan_match(spark, sf_dir):
    return _digits(_matched(spark, sf_dir))


@query
def plan_match_stats(spark, sf_dir):
    stats = courses.course_stats(bridge.sections(spark, sf_dir))
    return _digits(matching.attach_metrics(bridge.plan_rows(spark, sf_dir), stats, STAT_METRICS, bridge.ALIASES))


@query
def choice_group_gpa(spark, sf_dir):
    return _digits(rollup.choice_group_means(_matched(spark, sf_dir)))


@query
def major_expected_gpa(spark, sf_dir):
    return _digits(
        rollup.rank_majors(bridge.plan_rows(spark, sf_dir), bridge.sections(spark, sf_dir), bridge.ALIASES)
    )


@query
def low_coverage(spark, sf_dir):
    return _digits(rollup.low_coverage(rollup.major_expected_gpa(_matched(spark, sf_dir)), 80.0))


@query
def difficulty_index(spark, sf_dir):
    return _digits(
        rollup.difficulty_index(bridge.plan_rows(spark, sf_dir), bridge.sections(spark, sf_dir), bridge.ALIASES)
    )


@query
def best_option_relaxed(spark, sf_dir):
    return _digits(choice.choice_groups(_matched(spark, sf_dir)))


@query
def option_conflicts(spark, sf_dir):
    return choice.option_conflicts(choice.choice_groups(_matched(spark, sf_dir)))


@query
def optimal_plan(spark, sf_dir):
    return _digits(choice.optimize_plans(_matched(spark, sf_dir))[0])


@query
def optimize_all_majors(spark, sf_dir):
    plan, s = bridge.plan_rows(spark, sf_dir), bridge.sections(spark, sf_dir)
    return _digits(choice.optimize_all_majors(plan, s, bridge.ALIASES)[0])


@query
def optimal_selections(spark, sf_dir):
    return _digits(choice.optimize_plans(_matched(spark, sf_dir))[1])


@query
def optimizer_comparison(spark, sf_dir):
    return _digits(choice.optimizer_comparison(_matched(spark, sf_dir)))


# Associations


@query
def pearson_matrix(spark, sf_dir):
    return _digits(association.pearson_pairs(_prepared(spark, sf_dir), NUMERIC))


@query
def pearson_by_type(spark, sf_dir):
    return _digits(association.pearson_pairs(_prepared(spark, sf_dir).select("Section", *NUMERIC)))


@query
def spearman_matrix(spark, sf_dir):
    return _digits(association.spearman_pairs(_prepared(spark, sf_dir), NUMERIC))


@query
def spearman_top_pairs(spark, sf_dir):
    return _digits(association.top_pairs(association.spearman_pairs(_prepared(spark, sf_dir), NUMERIC)))


@query
def kendall_tau_b(spark, sf_dir):
    return _digits(association.kendall_pairs(_prepared(spark, sf_dir), ["A", "F", "GPA", "Total"]))


@query
def kendall_matrix(spark, sf_dir):
    return _digits(association.kendall_pairs(_prepared(spark, sf_dir), NUMERIC))


@query
def theils_u(spark, sf_dir):
    return _digits(association.theils_u(_prepared(spark, sf_dir), [*NOMINAL, "Section"]))


@query
def correlation_ratio(spark, sf_dir):
    return _digits(association.correlation_ratio(_prepared(spark, sf_dir), NOMINAL, NUMERIC))


@query
def mixed_associations(spark, sf_dir):
    return _digits(association.mixed_associations(_prepared(spark, sf_dir), [*NOMINAL, "Section"], NUMERIC))


@query
def chi2_contingency(spark, sf_dir):
    return _digits(association.chi2_pairs(_prepared(spark, sf_dir), [*NOMINAL, "Section", *NUMERIC]))


@query
def phik_matrix(spark, sf_dir):
    nominal = [*NOMINAL, "Section", "Class_Code"]
    # Read for the spans of the bins and for the counts.
    prepared = stage(_prepared(spark, sf_dir).select(*nominal, *NUMERIC)).df
    return _digits(association.phik_pairs(prepared, nominal, NUMERIC), 3)


# Documents


@query
def plan_grid_parse(spark, sf_dir):
    return _digits(documents.parse_plans(bridge.plan_pages(spark, sf_dir)))


@query
def plan_footnotes(spark, sf_dir):
    return documents.parse_footnotes(bridge.plan_pages(spark, sf_dir))


@query
def footnote_maps(spark, sf_dir):
    return documents.footnotes_to_rows(documents.footnote_maps(bridge.plan_pages(spark, sf_dir)))


@query
def empty_pages(spark, sf_dir):
    plain = bridge.table(spark, sf_dir, "region").select(
        F.concat(F.lit("N"), F.col("r_regionkey").cast("string")).alias("major"),
        F.concat(F.lit("<html><table><tr><td>"), "r_name", F.lit("</td><td>x</td></tr></table></html>")).alias("html"),
    )
    pages = bridge.plan_pages(spark, sf_dir).unionByName(plain)
    return documents.pages_without_rows(pages, documents.parse_plans(pages))


@query
def plan_counts(spark, sf_dir):
    return documents.plan_counts(documents.parse_plans(bridge.plan_pages(spark, sf_dir)))


@query
def plan_preview(spark, sf_dir):
    return documents.preview(documents.parse_plans(bridge.plan_pages(spark, sf_dir)))


@query
def page_outline(spark, sf_dir):
    return outline.page_outline(bridge.table(spark, sf_dir, "pages"))


@query
def page_links(spark, sf_dir):
    return outline.page_links(bridge.table(spark, sf_dir, "pages"))


@query
def url_values(spark, sf_dir):
    pages = bridge.table(spark, sf_dir, "pages")
    return outline.url_values(pages, "page").join(
        outline.url_values(pages, "ref").withColumnRenamed("value", "ref"), "page_id"
    )


@query
def slugify(spark, sf_dir):
    part = bridge.table(spark, sf_dir, "part").select(F.col("p_name").alias("name"))
    supplier = bridge.table(spark, sf_dir, "supplier").select(F.concat(F.lit("# "), "s_name", F.lit(" - BS ")).alias("name"))
    return part.unionAll(supplier).select("name", slug("name").alias("slug"))


# Work list


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    colleges = bridge.table(spark, sf_dir, "region").select(F.replace("r_name", F.lit(" "), F.lit("_")).alias("college"))
    span = bridge.table(spark, sf_dir, "lineitem").agg(
        F.struct(F.min(F.year("l_shipdate")).alias("first"), F.max(F.year("l_shipdate")).alias("last")).alias("s")
    )
    years = span.scalar()
    return worklist.work_grid(
        colleges, years.getField("first"), years.getField("last"), "https://example.org/reports", "data"
    )


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files as if each section took 8 bytes."""
    raw = bridge.raw_sections(spark, sf_dir)
    return raw.groupBy(F.concat(F.lit("data/grd/"), "source_file").alias("path")).agg(
        (F.count("*") * 8).alias("length")
    )


@query
def work_grid(spark, sf_dir):
    return _grid(spark, sf_dir)


@query
def pending_files(spark, sf_dir):
    return worklist.pending(_grid(spark, sf_dir), _manifest(spark, sf_dir))


@query
def file_tally(spark, sf_dir):
    return worklist.outcome_tally(_grid(spark, sf_dir), _manifest(spark, sf_dir))


# Written tables and streams


@query
def partitioned_export(spark, sf_dir):
    path = shared_folder(spark)
    s = bridge.sections(spark, sf_dir).drop("source_file")
    tables.export_sections(s, path)
    back = files.read_partitioned(spark, path, s.schema)
    return back.groupBy(*PARTITION_COLUMNS).agg(
        F.count("*").alias("n_rows"), F.sum("Total").alias("students"), F.countDistinct("Class_Code").alias("n_courses")
    )


def _report(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A report over exported tables, in a session of its own so that its views meet no others."""
    folder, own = shared_folder(spark), spark.newSession()
    s = bridge.sections(own, sf_dir)
    if name in reports.LIVE:
        tables.export_sections(s.drop("source_file"), f"{folder}/grade_distributions")
        files.read_partitioned(own, f"{folder}/grade_distributions", s.drop("source_file").schema).createOrReplaceTempView("grade_distributions")
    else:
        view = {"expected_gpa": "major_expected_gpa", "difficulty_index": "major_difficulty_index"}.get(name, name)
        result = reports.analyse(bridge.plan_rows(own, sf_dir), s, bridge.ALIASES)[view]
        tables.export_result(result, f"{folder}/{view}.parquet")
        own.read.parquet(f"{folder}/{view}.parquet").createOrReplaceTempView(view)
    return _digits(reports.report(own, name))


@query
def exported_index_report(spark, sf_dir):
    return _report(spark, sf_dir, "difficulty_index")


@query
def report_expected_gpa(spark, sf_dir):
    return _report(spark, sf_dir, "expected_gpa")


@query
def report_optimizer_comparison(spark, sf_dir):
    return _report(spark, sf_dir, "optimizer_comparison")


@query
def report_optimizer_selections(spark, sf_dir):
    return _report(spark, sf_dir, "optimizer_selections")


@query
def report_kpis(spark, sf_dir):
    return _report(spark, sf_dir, "kpis")


@query
def report_hardest_courses(spark, sf_dir):
    return _report(spark, sf_dir, "hardest_courses")


@query
def report_easiest_courses(spark, sf_dir):
    return _report(spark, sf_dir, "easiest_courses")


@query
def report_yearly_trend(spark, sf_dir):
    return _report(spark, sf_dir, "yearly_trend")


@query
def export_by_major(spark, sf_dir):
    folder, plan = shared_folder(spark), bridge.plan_rows(spark, sf_dir)
    tables.export_plan_rows(plan, folder)
    back = files.read_partitioned(spark, folder, plan.schema)
    return _digits(back.groupBy("major").agg(F.count("*").alias("n_rows"), F.sum("credit_hours").alias("credit_hours")))


def _through_table(spark: SparkSession, *steps: Callable[[str], bool]) -> DataFrame:
    """Rows of a table after some writes; the table itself goes again."""
    name = f"lens_{uuid.uuid4().hex}"
    try:
        for step in steps:
            step(name)
        return stage(spark.table(name)).df
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _two_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    s = bridge.sections(spark, sf_dir)
    return (
        s.where("Total >= 25").select("Class_Code", "Total", "GPA"),
        s.where("Total < 25").select("Instructor", "Total", "Class_Code"),
    )


@query
def append_table(spark, sf_dir):
    first, second = _two_frames(spark, sf_dir)
    return _through_table(spark, lambda n: tables.append_aligned(first, n), lambda n: tables.append_aligned(second, n))


@query
def replace_table(spark, sf_dir):
    first, second = _two_frames(spark, sf_dir)
    return _through_table(spark, lambda n: tables.replace_table(first, n), lambda n: tables.replace_table(second, n))


@query
def stream_ingest(spark, sf_dir):
    folder = shared_folder(spark)
    raw = bridge.raw_sections(spark, sf_dir).drop("total_comma_raw").repartition(8)
    raw.write.parquet(f"{folder}/incoming")
    target = bridge.sections(spark, sf_dir).schema
    taken = ingest.ingest_files(
        spark, f"{folder}/incoming", raw.schema, sec.clean_sections, target,
        f"{folder}/sections", f"{folder}/checkpoint", files_per_batch=4,
    )
    return taken.groupBy("College", "Year").agg(
        F.count("*").alias("n_rows"), F.sum("Total").alias("students"), F.count("GPA").alias("n_gpa"),
    )


@query
def stream_rejects(spark, sf_dir):
    """Beside good files, one broken file per region: its bytes are the region's name."""
    folder = shared_folder(spark)
    raw = bridge.raw_sections(spark, sf_dir).drop("total_comma_raw")
    raw.write.parquet(f"{folder}/incoming")
    jvm = spark.sparkContext._jvm
    for r in bridge.table(spark, sf_dir, "region").collect():  # a handful
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/incoming/broken_{r['r_regionkey']}.parquet")
        out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
        out.write(bytearray(r["r_name"].encode()))
        out.close()
    ingest.ingest_files(
        spark, f"{folder}/incoming", raw.schema, sec.clean_sections, bridge.sections(spark, sf_dir).schema,
        f"{folder}/sections", f"{folder}/checkpoint",
    )
    name = F.regexp_extract("path", "[^/]*$", 0)
    return ingest.rejected_files(spark, f"{folder}/sections").select(name.alias("name"), "length", "reason")


@query
def events_running_mean(spark, sf_dir):
    folder = shared_folder(spark)
    schema = bridge.table(spark, sf_dir, "events").schema
    # A pattern fits one file as well as a folder of files.
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")
    weighted = events.withColumn("w", F.col("event_id") % 5 + 1)
    return _digits(
        ingest.running_mean(weighted, "user_id", "value", "w", f"{folder}/state", f"{folder}/checkpoint")
    )
