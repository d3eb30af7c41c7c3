"""Readers of report files, cached pages and exported tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import slug


def file_manifest(spark: SparkSession, folder: str, suffix: str = ".pdf") -> DataFrame:
    """(path, name, length) of the files below `folder` with a suffix in any case, by name.

    Only the listing is read: the content column is pruned.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = F.regexp_extract("path", r"[^/]*$", 0)
    return (
        files.select("path", name.alias("name"), "length")
        .where(F.lower("name").endswith(suffix.lower()))
        .orderBy("name")
    )


def cached_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(stem, html) of the cached pages that are not empty."""
    pages = spark.read.option("pathGlobFilter", "*.html").text(folder, wholetext=True)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*)\.html$", 1)
    return pages.select(F.url_decode(name).alias("stem"), F.col("value").alias("html")).where(F.length("html") > 0)


def pages_of(sources: DataFrame, cached: DataFrame) -> DataFrame:
    """(major, html) of the sources (column `major`) that have a cached page."""
    return sources.withColumn("stem", slug("major")).join(cached, "stem").select("major", "html")


def pages_to_fetch(sources: DataFrame, cached: DataFrame) -> DataFrame:
    """Sources without a cached page."""
    return sources.withColumn("stem", slug("major")).join(cached.select("stem"), "stem", "left_anti").drop("stem")


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Hive-partitioned folder with a fixed schema and order of columns.

    The schema names the types of the partition columns too: one folder named
    `Unknown` must not turn the years of all others into text.
    """
    return spark.read.schema(schema).parquet(path).select(*schema.names)
