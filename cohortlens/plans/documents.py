"""Plan grids in HTML to plan rows (`schemas.PLAN_ROWS`) and footnotes.

Pages come as (major, html), one page per major. A page is cut and its rows are
numbered in one walk inside the scan (`grid_pages`), so nothing is shuffled. Markup
that does not match yields no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.elements import list_items
from ..functions.text import text_of
from ..schemas import PLAN_ROWS
from . import grid_pages
from .patterns import INDENT_OPEN, LINK, NOTES_OPEN, UNSEEN  # noqa: F401 - all names of the markup are had from here


def all_matches(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def parse_plans(pages: DataFrame) -> DataFrame:
    """(major, html) to plan rows of all pages."""
    return pages.select(F.col("major").cast("string"), F.col("html").cast("string")).mapInArrow(grid_pages.parse, PLAN_ROWS)


def pages_without_rows(pages: DataFrame, plan: DataFrame) -> DataFrame:
    """Majors whose page gave no plan row."""
    return pages.select("major").join(plan.select("major").distinct(), "major", "left_anti")


def parse_footnotes(pages: DataFrame) -> DataFrame:
    """(major, footnote_num, footnote_text) from the first footnote list of each page.

    Terms and texts pair up by position, those of lists within a text included; a
    repeated number keeps its last text.
    """
    seen = F.regexp_replace("html", UNSEEN, "")
    items = list_items(seen, "dl", NOTES_OPEN, ("dt", "dd"))

    def texts(tag: str) -> Column:
        return F.transform(F.filter("items", lambda i: i["tag"] == tag), lambda i: i["text"])

    zipped = F.arrays_zip(texts("dt").alias("term"), texts("dd").alias("text"))
    listed = pages.select("major", F.when(F.contains(seen, F.lit("sc_footnotes")), items).alias("items"))
    pairs = listed.select("major", F.posexplode(zipped).alias("pos", "z")).where(
        "z.term IS NOT NULL AND z.text IS NOT NULL"
    )
    named = pairs.select("major", "pos", text_of("z.term").alias("footnote_num"), text_of("z.text", " ").alias("t"))
    return (
        named.where("footnote_num <> ''")
        .groupBy("major", "footnote_num")
        .agg(F.max_by("t", "pos").alias("footnote_text"))
    )


def footnote_maps(pages: DataFrame) -> DataFrame:
    """(major, map of number to text): the nested form of `parse_footnotes`."""
    entries = F.collect_list(F.struct("footnote_num", "footnote_text"))
    return parse_footnotes(pages).groupBy("major").agg(F.map_from_entries(entries).alias("footnotes"))


def footnotes_to_rows(maps: DataFrame) -> DataFrame:
    return maps.select("major", F.explode("footnotes").alias("footnote_num", "footnote_text"))


def plan_counts(plan: DataFrame) -> DataFrame:
    """Number of plan rows and of majors."""
    return plan.agg(F.count("*").alias("n_rows"), F.countDistinct("major").alias("n_majors"))


def preview(plan: DataFrame, n: int = 30) -> DataFrame:
    """The first rows in document order."""
    return plan.orderBy("major", "row_order").limit(n)
