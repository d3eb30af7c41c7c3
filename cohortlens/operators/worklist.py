"""The grid of expected report files and what is still missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..codes import COLLEGE_CODES, FIRST_YEAR, MIN_FILE_BYTES, REPORT_TYPES, SEMESTERS
from ..functions.text import slug


def distinct_in_order(codes: list[str]) -> list[str]:
    """Drop repeated codes, first one stays."""
    return list(dict.fromkeys(codes))


def report_url(base: Column, year: Column, semester: Column, report_type: Column, college: Column) -> Column:
    """`<base>/<year><semester>/<type><year><semester><college>.pdf`; unknown codes raise."""
    term = F.concat(year.cast("string"), semester.cast("string"))
    url = F.concat(base, F.lit("/"), term, F.lit("/"), report_type, term, college, F.lit(".pdf"))
    return (
        F.when(~semester.isin(SEMESTERS), F.raise_error(F.lit("invalid semester code")).cast("string"))
        .when(~report_type.isin(REPORT_TYPES), F.raise_error(F.lit("unknown report type")).cast("string"))
        .otherwise(url)
    )


def report_path(folder: Column, year: Column, semester: Column, report_type: Column, college: Column) -> Column:
    """`<type>_<year>_<semester>_<college>.pdf`; section reports lie in a folder of their own."""
    name = F.concat(
        F.concat_ws("_", report_type, year.cast("string"), semester.cast("string"), college), F.lit(".pdf")
    )
    return F.concat_ws("/", folder, F.when(report_type == "grd", F.lit("grd")), name)


def page_path(folder: Column, major: Column) -> Column:
    """`<slug of the major>.html`."""
    return F.concat(folder, F.lit("/"), slug(major), F.lit(".html"))


def work_grid(
    colleges: DataFrame,
    first_year: Column,
    last_year: Column,
    base: str,
    folder: str,
    semesters: list[int] | None = None,
    report_types: list[str] | None = None,
) -> DataFrame:
    """Every college (column `college`) x year, newest first, x semester x report type.

    The code lists are short constants, so the grid grows inside each row.
    """
    years = F.sequence(last_year, first_year, F.lit(-1))
    grid = (
        colleges.select("college", F.explode(years).alias("year"))
        .withColumn("semester", F.explode(F.array(*[F.lit(s) for s in semesters or SEMESTERS])))
        .withColumn("report_type", F.explode(F.array(*[F.lit(r) for r in report_types or REPORT_TYPES])))
    )
    parts = [F.col(c) for c in ("year", "semester", "report_type", "college")]
    return grid.select(
        *parts, report_url(F.lit(base), *parts).alias("url"), report_path(F.lit(folder), *parts).alias("path")
    )


def standard_grid(last_year: DataFrame, base: str, folder: str, first_year: int = FIRST_YEAR) -> DataFrame:
    """The grid of all known colleges, each once, up to the year in the one row of `last_year` (column `year`)."""
    codes = F.array(*[F.lit(c) for c in distinct_in_order(COLLEGE_CODES)])
    colleges = last_year.select(F.explode(codes).alias("college"), F.col("year").alias("_last"))
    return work_grid(colleges, F.lit(first_year), F.col("_last"), base, folder)


def valid_files(manifest: DataFrame, min_bytes: int = MIN_FILE_BYTES) -> DataFrame:
    """(path, length) rows large enough to be a report."""
    return manifest.where(F.col("length") >= min_bytes)


def pending(grid: DataFrame, manifest: DataFrame, min_bytes: int = MIN_FILE_BYTES) -> DataFrame:
    """Grid rows without a valid file."""
    return grid.join(valid_files(manifest, min_bytes).select("path"), "path", "left_anti")


def outcome_tally(grid: DataFrame, manifest: DataFrame, min_bytes: int = MIN_FILE_BYTES) -> DataFrame:
    """Number of grid rows that are present, too small or missing."""
    found = grid.join(manifest.select("path", "length"), "path", "left")
    status = (
        F.when(F.col("length") >= min_bytes, "present").when(F.col("length").isNotNull(), "too small").otherwise("missing")
    )
    return found.groupBy(status.alias("status")).agg(F.count("*").alias("n"))
