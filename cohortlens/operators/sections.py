"""From raw text rows to the typed section layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..codes import COLLEGE_GROUPS, COLLEGE_NAMES, HEADER_WORDS, SEMESTER_NAMES, UNKNOWN
from ..functions.numbers import count, half_even, number, ratio
from ..functions.text import split_last_dash
from ..schemas import COUNT_COLUMNS


def label(code: Column, names: dict[str, str]) -> Column:
    """Code to label; a code without a label stays as it is."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), code)


def _fields_of(parts: Column) -> dict[str, Column]:
    """College, Year and Semester from the parts of a file name between `_`."""
    known = (F.size(parts) >= 4) & (F.lower(F.get(parts, F.lit(0))) == "grd")
    # The ending holds no `_`, so with four parts or more it belongs to the college alone.
    tail = F.array_join(F.slice(parts, 4, F.greatest(F.size(parts) - 3, F.lit(0))), "_")
    college = F.upper(F.regexp_replace(tail, r"(?:\.PDF)?(?:\.pdf)?\z", ""))

    def given(c: Column) -> Column:
        return F.when(known, c).otherwise(F.lit(UNKNOWN))

    return {"College": given(college), "Year": given(F.get(parts, F.lit(1))), "Semester": given(F.get(parts, F.lit(2)))}


def _parts(name: Column) -> Column:
    return F.split(F.substring_index(name, "/", -1), "_")


_LABELS = {"College": COLLEGE_NAMES, "Semester": SEMESTER_NAMES}


def file_fields(name: Column) -> dict[str, Column]:
    """College, Year and Semester from `grd_<year>_<semester>_<college>.pdf`."""
    fields = _fields_of(_parts(name))
    return {c: label(v, _LABELS[c]) if c in _LABELS else v for c, v in fields.items()}


def with_file_fields(df: DataFrame, file_column: str = "source_file") -> DataFrame:
    """Add `file_fields`. What is used more than once is a projection of its own, so it is worked out once."""
    cut = df.withColumn("_parts", _parts(F.col(f"`{file_column}`")))
    named = cut.withColumns(_fields_of(F.col("_parts"))).drop("_parts")
    return named.withColumns({c: label(F.col(c), names) for c, names in _LABELS.items()})


def prepend_columns(df: DataFrame, names: Sequence[str], values: Sequence) -> DataFrame:
    """Put constant (or computed) columns on the left; existing ones are overwritten in place."""
    if len(names) != len(values):
        raise ValueError("names and values differ in length")
    new = {n: v if isinstance(v, Column) else F.lit(v) for n, v in zip(names, values)}
    left = [v.alias(n) for n, v in new.items() if n not in df.columns]
    rest = [new[c].alias(c) if c in new else F.col(f"`{c}`") for c in df.columns]
    return df.select(*left, *rest)


def prepend_constants(df: DataFrame, names: Sequence[str], values: Sequence) -> DataFrame:
    """`prepend_columns` where an empty frame gives one row of the constants alone."""
    if df.isEmpty():
        if len(names) != len(values):
            raise ValueError("names and values differ in length")
        return df.sparkSession.range(1).select(*[F.lit(v).alias(n) for n, v in zip(names, values)])
    return prepend_columns(df, names, values)


def add_file_fields(df: DataFrame, file_column: str = "source_file") -> DataFrame:
    fields = ["College", "Year", "Semester"]
    left = [c for c in fields if c not in df.columns]
    return with_file_fields(df, file_column).select(*left, *(f"`{c}`" for c in df.columns))


def split_section(df: DataFrame, column: str = "Section") -> DataFrame:
    """Replace `column` in place by `Class Code` and `Section`, cut at the last dash."""
    if column not in df.columns:
        return df
    code, section = split_last_dash(F.col(f"`{column}`"))
    out: list[Column] = []
    for c in df.columns:
        out += [code.alias("Class Code"), section.alias("Section")] if c == column else [F.col(f"`{c}`")]
    return df.select(*out)


def sql_names(df: DataFrame) -> DataFrame:
    """SQL-safe names: `Class Code` -> `Class_Code`, `Total A-F` -> `Total_A_F`; the blank column goes."""
    kept = df.drop(*[c for c in df.columns if not c.strip()])
    return kept.withColumnsRenamed({"Class Code": "Class_Code", "Total A-F": "Total_A_F"})


def typed(df: DataFrame) -> DataFrame:
    """Counts to bigint and GPA to double where present; stray text becomes null.

    Columns that hold numbers already are not parsed again.
    """
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    casts = {
        c: count(c) if c in text else F.col(c).cast("bigint") for c in COUNT_COLUMNS if c in df.columns
    }
    if "GPA" in df.columns:
        casts["GPA"] = number("GPA") if "GPA" in text else F.col("GPA").cast("double")
    return df.withColumns(casts)


def clean_sections(raw: DataFrame) -> DataFrame:
    """Raw text rows with `Section` and `source_file` to the typed section layer."""
    return typed(sql_names(split_section(add_file_fields(raw))))


def drop_header_rows(df: DataFrame, column: str = "Section") -> DataFrame:
    """Drop rows whose section text names a total, a page or an instructor; null stays."""
    text = F.coalesce(F.lower(F.col(f"`{column}`")), F.lit(""))
    hit = F.lit(False)
    for word in HEADER_WORDS:
        hit = hit | F.contains(text, F.lit(word))
    return df.where(~hit)


def for_correlation(sections: DataFrame) -> DataFrame:
    """Typed counts, percentages, class size and a numeric year, without header rows."""
    df = typed(sql_names(sections))
    new = {
        "Pct_A": half_even(ratio("A", "Total_A_F") * 100, 1),
        "Pct_graded": half_even(ratio("Total_A_F", "Total") * 100, 1),
        "Class_Size": F.col("Total"),
    }
    if "Year" in df.columns:
        new["Year"] = count("Year")
    return drop_header_rows(df.withColumns(new))


def college_group_totals(
    sections: DataFrame, groups: dict[str, list[str]] | None = None, column: str = "College"
) -> DataFrame:
    """Section and student totals by reporting group and college, with subtotals.

    A college in several groups counts in each; one in none is `OTHER`.
    """
    groups = COLLEGE_GROUPS if groups is None else groups
    of_college: dict[str, list[str]] = {}
    for group, members in groups.items():
        for m in members:
            of_college.setdefault(m, []).append(group)
    pairs = [
        x for m, gs in of_college.items() for x in (F.lit(m), F.array(*[F.lit(g) for g in gs]))
    ]
    # One row per college first: the group expansion then touches no fact row.
    per_college = sections.groupBy(F.col(column).alias("college")).agg(
        F.count("*").alias("_rows"), F.sum("Total").alias("_students")
    )
    group = F.lit("OTHER")
    if pairs:
        found = F.try_element_at(F.create_map(*pairs), F.col("college"))
        group = F.explode(F.coalesce(found, F.array(F.lit("OTHER"))))
    return (
        per_college.withColumn("college_group", group)
        .rollup("college_group", "college")
        .agg(
            F.sum("_rows").alias("n_sections"),
            F.coalesce(F.sum("_students"), F.lit(0).cast("bigint")).alias("n_students"),
            F.grouping_id().cast("int").alias("level"),
        )
    )
