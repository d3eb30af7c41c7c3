"""Cleanup of extracted table grids (`schemas.GRID`): one row per table row, cells as an array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..codes import GRID_COLUMNS, NOISE_KEYWORDS
from ..functions.numbers import whole_number
from ..functions.text import blank_to_null, keyword_hit
from ..scale import stage

TABLE = ["source_file", "table_idx"]


def blank_cells_to_null(grid: DataFrame) -> DataFrame:
    return grid.withColumn("cells", F.transform("cells", lambda c: blank_to_null(c)))


def table_extents(grid: DataFrame) -> DataFrame:
    """Per table: first and last column with content, and the width of the file.

    Tables without content have no row. Rows are reduced to two numbers before
    the shuffle, so a table of any length stays cheap.
    """
    filled = F.filter(
        F.transform("cells", lambda c, i: F.when(c.isNotNull(), i)), lambda i: i.isNotNull()
    )
    edges = grid.select(
        *TABLE, F.array_min(filled).alias("lo"), F.array_max(filled).alias("hi")
    ).where("lo IS NOT NULL")
    tables = stage(edges.groupBy(*TABLE).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))).df
    files = tables.groupBy("source_file").agg(F.max(F.col("hi") - F.col("lo") + 1).alias("width"))
    return tables.join(files, "source_file")


def trim_and_pad(grid: DataFrame) -> DataFrame:
    """Blank cells become null, empty outer columns and empty tables go, and
    all tables of a file get its widest table's width, nulls on the right.

    Columns line up by position; the order is `table_idx`, `row_idx`.
    """
    clean = blank_cells_to_null(grid)
    fitted = clean.join(table_extents(clean), TABLE)
    span = F.col("hi") - F.col("lo") + 1
    kept = F.slice("cells", F.col("lo") + 1, span)
    # A short row of a ragged table is padded like a narrow table.
    missing = F.col("width") - F.size(kept)
    padded = F.concat(kept, F.array_repeat(F.lit(None).cast("string"), missing))
    return fitted.select(*TABLE, "row_idx", padded.alias("cells"))


def name_columns(grid: DataFrame, names: list[str] | None = None, width: int | None = None) -> DataFrame:
    """Cells to columns by position.

    Extra names are ignored and extra cells keep the name `column_<i>`; `width`
    is the number of cells to keep (default: the number of names).
    """
    names = GRID_COLUMNS if names is None else names
    width = len(names) if width is None else width
    titles = [names[i] if i < len(names) else f"column_{i}" for i in range(width)]
    keys = [c for c in grid.columns if c != "cells"]
    return grid.select(
        *keys, *[F.get("cells", F.lit(i)).alias(title) for i, title in enumerate(titles)]
    )


def name_columns_if_complete(grid: DataFrame, names: list[str]) -> DataFrame:
    """Columns take `names` on rows whose width fits; other rows keep `cells`."""
    fits = F.size("cells") == len(names)
    keys = [c for c in grid.columns if c != "cells"]
    return grid.select(
        *keys,
        *[F.when(fits, F.get("cells", F.lit(i))).alias(n) for i, n in enumerate(names)],
        F.when(~fits, F.col("cells")).alias("cells"),
    )


def rename_loosely(df: DataFrame, names: list[str]) -> DataFrame:
    """Rename by position; surplus names or columns stay as they are."""
    return df.withColumnsRenamed(dict(zip(df.columns, names)))


def rename_strictly(df: DataFrame, names: list[str]) -> DataFrame:
    """Rename all columns; a different count is an error."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def drop_keyword_rows(
    df: DataFrame, keywords: list[str], columns: list[str] | None = None
) -> DataFrame:
    """Drop rows whose cells, joined by a space, contain a keyword in any case."""
    if not keywords:
        return df
    cells: list[Column] = [F.col(f"`{c}`") for c in (columns or df.columns)]
    return df.where(~keyword_hit(cells, keywords))


def header_as_first_row(df: DataFrame, order: str | None = None) -> DataFrame:
    """Put the column names in front as data; all columns become text.

    With `order` the new row gets -1 in that column and sorts first.
    """
    spark = df.sparkSession
    text = df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    names = ["-1" if c == order else c for c in df.columns]
    header = spark.range(1).select([F.lit(n).alias(c) for n, c in zip(names, df.columns)])
    has_rows = df.select(F.lit(1).alias("n")).limit(1).agg(F.count("n").alias("n")).scalar()
    return header.where(has_rows > 0).unionByName(text)


def to_whole_numbers(
    df: DataFrame, columns: str | list[str], errors: str = "coerce", fill: int = 0
) -> DataFrame:
    """Turn text columns into bigint: commas and blanks go, nulls become `fill`."""
    columns = [columns] if isinstance(columns, str) else columns
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.withColumns(
        {c: whole_number(F.col(f"`{c}`"), fill, errors == "raise") for c in columns}
    )


def grid_to_rows(grid: DataFrame, width: int | None = None) -> DataFrame:
    """Raw grid to named text rows without totals rows."""
    named = name_columns(trim_and_pad(grid), width=width)
    text = [c for c in named.columns if c not in (*TABLE, "row_idx")]
    return drop_keyword_rows(named, NOISE_KEYWORDS, text)
