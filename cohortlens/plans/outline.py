"""Outline and links of general web pages, with the same tools as plan grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import attribute, query_value, squeeze, text_of
from .documents import LINK, UNSEEN, all_matches

PART = r"(?is)<(?:h1|p|li)\b[^>]*>.*?(?=</h1>|</p>|</li>|<(?:h1|p|li)\b|$)"


def page_outline(pages: DataFrame) -> DataFrame:
    """(page_id, item_order, kind, heading, block_no, text): headings, paragraphs and list items.

    The last heading is carried down; `block_no` counts paragraphs so far.
    """
    seen = F.regexp_replace("html", UNSEEN, "")
    parts = pages.select("page_id", F.posexplode(all_matches(seen, PART)).alias("pos", "part"))
    rows = parts.select(
        "page_id", "pos",
        F.lower(F.regexp_extract("part", r"^<(\w+)", 1)).alias("kind"),
        squeeze(text_of("part", " ")).alias("text"),
    )
    page = Window.partitionBy("page_id").orderBy("pos")
    return rows.select(
        "page_id",
        (F.row_number().over(page) - 1).alias("item_order"),
        "kind",
        F.last(F.when(F.col("kind") == "h1", F.col("text")), ignorenulls=True).over(page).alias("heading"),
        F.sum((F.col("kind") == "p").cast("int")).over(page).alias("block_no"),
        "text",
    )


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, link_no, href, text): links of a page in document order."""
    seen = F.regexp_replace("html", UNSEEN, "")
    links = pages.select("page_id", F.posexplode(all_matches(seen, r"(?is)<a\b[^>]*>.*?(?:</a>|$)")).alias("link_no", "a"))
    return links.select(
        "page_id", "link_no",
        attribute(F.regexp_extract("a", LINK, 1), "href").alias("href"),
        squeeze(text_of(F.regexp_extract("a", LINK, 2))).alias("text"),
    )


def url_values(pages: DataFrame, name: str) -> DataFrame:
    """(page_id, value): the query parameter `name` of each page's address, null if absent."""
    return pages.select("page_id", query_value("url", name).alias("value"))
