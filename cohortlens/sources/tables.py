"""Tables: existence, guards, schema-aligned appends, partitioned exports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sections import sql_names, typed
from ..scale import remove_folder, stage
from ..schemas import PARTITION_COLUMNS

# Target size of a row group in an export.
ROW_GROUP_BYTES = 128 * 1024 * 1024
# Majors of plan rows that have a folder each, and folders that more of them share.
MAJOR_FOLDERS = 1_000
MAJOR_PARTS = 64
MAJOR_PART = "major_part"


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty frame with typed columns if there is none."""
    return spark.table(name) if table_exists(spark, name) else spark.createDataFrame([], schema)


def has_columns(df: DataFrame, required: Iterable[str]) -> bool:
    return set(required) <= set(df.columns)


def row_count(spark: SparkSession, name: str) -> int:
    """Rows of a table; -1 if it cannot be read."""
    try:
        return spark.table(name).count()
    except AnalysisException:
        return -1


def column_names(spark: SparkSession, name: str) -> list[str]:
    return spark.table(name).columns


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of `schema` in its order and types; others go, missing ones are null.

    Values that do not fit the type become null.
    """
    have = set(df.columns)
    return df.select(
        [
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def append_aligned(df: DataFrame, name: str, partition_by: list[str] | None = None) -> bool:
    """Append to a table, cut to its columns; the first append creates it.

    An empty frame appends nothing and gives False.
    """
    spark, seen = df.sparkSession, Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if table_exists(spark, name):
        align(counted, spark.table(name).schema).write.insertInto(name)
    else:
        writer = counted.write.format("parquet")
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
        if seen.get["rows"] == 0:
            spark.sql(f"DROP TABLE {name}")
    return seen.get["rows"] > 0


def replace_table(df: DataFrame, name: str) -> bool:
    """Replace a table and its columns; an empty frame changes nothing and gives False.

    The rows are staged first, so the old table stands until all new ones are there.
    `versions.TableSet` replaces several tables as a whole.
    """
    staged = stage(df)
    if staged.rows == 0:
        return False
    staged.df.write.format("parquet").mode("overwrite").saveAsTable(name)
    return True


def union_aligned(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows, with the columns of the first frame; repeated rows stay."""
    out = first
    for other in others:
        out = out.unionAll(align(other, first.schema))
    return out


def export_sections(sections: DataFrame, path: str) -> bool:
    """Write sections by college, year and semester; only the partitions at hand are replaced.

    Rows are gathered by partition first, so a partition gets few files; the
    rebalance splits a partition that is too large for one task.
    """
    rows = typed(sql_names(sections)).hint("rebalance", *PARTITION_COLUMNS)
    return _overwrite(rows, path, PARTITION_COLUMNS) > 0


def export_plan_rows(plan: DataFrame, path: str) -> bool:
    """Write plan rows by major; only the majors at hand are replaced.

    Up to `MAJOR_FOLDERS` majors have a folder each. More of them share `MAJOR_PARTS` folders,
    dealt by hash: a folder and a file for each costs far more than its rows. There the major
    stays a column and rows lie in its order, so a reader of one major takes one folder and
    skips row groups by their least and greatest major. A path that has shared folders keeps them;
    folders of single majors move into them when there are too many. `read_partitioned` reads both.
    """
    staged = stage(plan)
    if staged.rows == 0:
        return False
    rows, spark = staged.df, plan.sparkSession
    names = _folders(spark, path)
    single = [n for n in names if n.startswith("major=")]
    shared = any(n.startswith(f"{MAJOR_PART}=") for n in names)
    majors = rows.select("major").distinct()
    if not shared and majors.count() <= MAJOR_FOLDERS:
        return _overwrite(rows.hint("rebalance", "major"), path, ["major"]) > 0
    rows = rows.withColumn(MAJOR_PART, _major_part())
    if names:
        # Rows of other majors in the folders that are written again, or in folders that go.
        old = spark.read.schema(plan.schema).parquet(path).select(*(f"`{c}`" for c in plan.columns)).withColumn(MAJOR_PART, _major_part())
        if not single:
            old = old.join(F.broadcast(rows.select(MAJOR_PART).distinct()), MAJOR_PART, "left_semi")
        at_hand = majors.select(F.col("major").alias("_major"))
        kept = old.join(at_hand, F.col("major").eqNullSafe(F.col("_major")), "left_anti")
        rows = stage(rows.unionByName(kept)).df
    _overwrite(rows.hint("rebalance", MAJOR_PART).sortWithinPartitions(MAJOR_PART, "major"), path, [MAJOR_PART])
    for name in single:
        remove_folder(spark, f"{path}/{name}")
    return True


def _major_part() -> Column:
    return F.pmod(F.xxhash64("major"), F.lit(MAJOR_PARTS)).cast("int")


def _folders(spark: SparkSession, path: str) -> list[str]:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory()] if fs.exists(place) else []


def export_result(result: DataFrame, path: str) -> None:
    """Write a report table; it has one row per major or per choice group."""
    result.write.mode("overwrite").option("compression", "snappy").parquet(path)


def _overwrite(df: DataFrame, path: str, keys: list[str]) -> int:
    """Replace the partitions at hand (none, if there are no rows); the number of rows, counted on the way."""
    seen = Observation()
    (
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .partitionBy(*keys)
        .parquet(path)
    )
    return seen.get["rows"]
