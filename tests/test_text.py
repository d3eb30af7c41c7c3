"""Literal examples of the column functions."""

import pytest
from pyspark.sql import functions as F

from cohortlens.functions import numbers, text
from cohortlens.operators import grid, sections, worklist


def one(spark, value, *columns):
    df = spark.createDataFrame([(value,)], "v string")
    return tuple(df.select(*columns).first())


@pytest.mark.parametrize(
    "value, expected",
    [
        ("MATH-151-501", ("MATH-151", "501")), ("ENGR-101-200", ("ENGR-101", "200")),
        ("PHYS-202", ("PHYS", "202")), ("ALONE", ("ALONE", None)), ("X- ", ("X", None)), (None, (None, None)),
    ],
)
def test_last_dash(spark, value, expected):
    assert one(spark, value, *text.split_last_dash("v")) == expected


@pytest.mark.parametrize(
    "value, expected",
    [("math-151", ("MATH", "151")), (" a - b-c ", ("A", "B-C")), ("MATH", ("MATH", None)), ("M-", ("M", ""))],
)
def test_first_dash(spark, value, expected):
    assert one(spark, value, *text.split_first_dash("v")) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("3", 3.0), (" 2.5 ", 2.5), ("1e3", 1000.0), ("-4", -4.0), ("5.", 5.0), (".5", 0.5), ("-------", None),
        ("1d", None), ("1f", None), ("nan", None), ("inf", None), ("-Infinity", None), ("0x1p3", None), ("", None), ("1,2", None),
        ("\t7\n", 7.0), (None, None),
    ],
)
def test_number(spark, value, expected):
    assert one(spark, value, numbers.number("v")) == (expected,)


@pytest.mark.parametrize("value, expected", [("1,234", 1234), (" 7 ", 7), ("2.9", 2), ("x", 0), (None, 0), ("12.0", 12)])
def test_whole_number(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v string")
    assert grid.to_whole_numbers(df, "v").first()[0] == expected


def test_whole_number_modes(spark):
    df = spark.createDataFrame([("x",)], "v string")
    with pytest.raises(Exception, match="not a number"):
        grid.to_whole_numbers(df, "v", errors="raise").collect()
    with pytest.raises(ValueError):
        grid.to_whole_numbers(df, ["v", "w"])


@pytest.mark.parametrize(
    "value, expected",
    [("3", (3, 3)), ("15-16", (15, 16)), ("1.5 - 3", (1.5, 3)), ("", (None, None)), ("TBD", (None, None)), ("ab 4 cr", (4, 4))],
)
def test_hours(spark, value, expected):
    assert one(spark, value, *text.hours("v")) == expected


@pytest.mark.parametrize(
    "value, expected",
    [("CSCE 222", ("CSCE", "222")), ("math151H", ("MATH", "151H")), ("CSCE 222/ECEN 222", (None, None)), ("", (None, None))],
)
def test_course_code(spark, value, expected):
    assert one(spark, value, *text.course_code("v")) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("/search/?P=CSCE%20222", "CSCE 222"), ("/s?x=1&P=A+B", "A B"), ("/s?P=&P=later", "later"),
        ("https://h/s?P=first&P=second#P=z", "first"), ("/s?XP=1", None), ("/s?P=100%zz", "100%zz"), (None, None),
    ],
)
def test_query_value(spark, value, expected):
    assert one(spark, value, text.query_value("v", "P")) == (expected,)


@pytest.mark.parametrize(
    "value, expected",
    [
        ("a &amp;lt; b", "a &lt; b"), ("&#8211;&#233;x", "–éx"), ("&nbsp;", " "), ("plain", "plain"),
        ("&lt;b&gt;", "<b>"), ("&unknown;", "&unknown;"), (None, None),
    ],
)
def test_unescape(spark, value, expected):
    assert one(spark, value, text.unescape("v")) == (expected,)


def test_markup(spark):
    cell = "Calc <b>I</b> <sup>1</sup><sup> 2 </sup>&nbsp;x"
    assert one(spark, cell, text.without_sup("v"), text.sup_marks("v")) == ("Calc I x", "1,2")
    assert one(spark, "no marks", text.without_sup("v"), text.sup_marks("v")) == ("no marks", None)
    assert one(spark, "First <b>Year</b>", text.text_of("v"), text.text_of("v", " ")) == ("FirstYear", "First Year")
    assert one(spark, "a  \n b ", text.squeeze("v")) == ("a b",)


def test_attribute(spark):
    tag = """<td data-class="no" class='a b' href="/x?a=1&amp;b=2">"""
    assert one(spark, tag, text.attribute("v", "class"), text.attribute("v", "href"), text.attribute("v", "id")) == (
        "a b", "/x?a=1&b=2", None,
    )


@pytest.mark.parametrize(
    "value, expected", [("Computer Science - BS", "computer_science___bs"), ("  Ärzte & Co. ", "ärzte___co"), ("--", "")]
)
def test_slug(spark, value, expected):
    assert one(spark, value, text.slug("v")) == (expected,)


@pytest.mark.parametrize(
    "name, expected",
    [
        ("grd_2023_3_EN.pdf", ("Engineering", "2023", "Fall")),
        ("/a/b/grd_2021_1_MD_PROF.pdf", ("Medicine - Professional", "2021", "Spring")),
        ("grd_2020_9_zz.PDF", ("ZZ", "2020", "9")), ("GRD_2020_2_SC", ("Science", "2020", "Summer")),
        ("gpac_2023_3_EN.pdf", ("Unknown",) * 3), ("grd_2023.pdf", ("Unknown",) * 3),
    ],
)
def test_file_fields(spark, name, expected):
    assert one(spark, name, *sections.file_fields(F.col("v")).values()) == expected


def test_rounding(spark):
    df = spark.createDataFrame([(0.25,), (0.35,), (6.25,), (2.675,)], "v double")
    assert [r[0] for r in df.select(numbers.half_even(F.col("v"), 1)).collect()] == [0.2, 0.4, 6.2, 2.7]
    assert [r[0] for r in df.select(numbers.half_up(F.col("v"), 2)).collect()] == [0.25, 0.35, 6.25, 2.68]


def test_report_addresses(spark):
    grid = worklist.work_grid(
        spark.createDataFrame([("EN",)], "college string"), F.lit(2022), F.lit(2023), "https://example.org", "d"
    )
    rows = grid.collect()
    assert len(rows) == 2 * 3 * 3 and rows[0].year == 2023
    by_path = {r.path: r.url for r in rows}
    assert by_path["d/grd/grd_2023_3_EN.pdf"] == "https://example.org/20233/grd20233EN.pdf"
    assert by_path["d/gpac_2022_1_EN.pdf"] == "https://example.org/20221/gpac20221EN.pdf"
    bad = worklist.work_grid(
        spark.createDataFrame([("EN",)], "college string"), F.lit(2022), F.lit(2022), "b", "d", semesters=[4]
    )
    with pytest.raises(Exception, match="invalid semester"):
        bad.collect()
    assert worklist.distinct_in_order(["PH", "A", "PH"]) == ["PH", "A"]
    assert one(spark, "Biology - BS", worklist.page_path(F.lit("h"), F.col("v"))) == ("h/biology___bs.html",)


def test_pending_and_tally(spark, rows):
    grid = spark.createDataFrame([("a",), ("b",), ("c",)], "path string")
    manifest = spark.createDataFrame([("a", 5000), ("b", 10)], "path string, length bigint")
    assert rows(worklist.pending(grid, manifest)) == [("b",), ("c",)]
    assert dict(worklist.outcome_tally(grid, manifest).collect()) == {"present": 1, "too small": 1, "missing": 1}


@pytest.mark.parametrize(
    "value, expected",
    [
        ("a &#x2013; b&#9;c", "a – b\tc"), ("&Agrave;&eacute;&hellip;", "Àé…"), ("&amp;lt; &lt;", "&lt; <"), ("&nosuch; & &#xD800;", "&nosuch; & \ufffd"),
        ("&#128512;", "😀"), ("plain", "plain"),
    ],
)
def test_references(spark, value, expected):
    assert one(spark, value, text.unescape("v")) == (expected,)


@pytest.mark.parametrize("value, expected", [("<td colspan=2>", "2"), ("<td class=a colspan='2'>", "2"), ('<td colspan = "2">', "2"), ("<td>", None)])
def test_attributes(spark, value, expected):
    assert one(spark, value, text.attribute("v", "colspan")) == (expected,)
