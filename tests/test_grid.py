import pytest

from cohortlens import schemas
from cohortlens.operators import grid, sections


def frame(spark, *tables):
    data = [("f.pdf", t, i, cells) for t, table in enumerate(tables) for i, cells in enumerate(table)]
    return spark.createDataFrame(data, schemas.GRID)


def test_trim_and_pad(spark):
    raw = frame(spark, [["", "a", "1"], [" ", "b", "2"]], [["c", "3", "4", ""]], [["", " "]])
    out = grid.trim_and_pad(raw).orderBy("table_idx", "row_idx").collect()
    assert [r.cells for r in out] == [["a", "1", None], ["b", "2", None], ["c", "3", "4"]]


def test_inner_blanks_stay_and_files_are_separate(spark):
    raw = frame(spark, [["a", "", "b"], ["", "", "c"]])
    other = spark.createDataFrame([("g.pdf", 0, 0, ["", "x"])], schemas.GRID)
    out = grid.trim_and_pad(raw.unionAll(other)).orderBy("source_file", "row_idx").collect()
    assert [r.cells for r in out] == [["a", None, "b"], [None, None, "c"], ["x"]]


def test_names(spark):
    raw = frame(spark, [["a", "b", "c"]])
    assert grid.name_columns(raw, ["x", "y"], width=3).columns[-3:] == ["x", "y", "column_2"]
    assert grid.name_columns(raw, ["x", "y", "z", "w"]).first().w is None
    done = grid.name_columns_if_complete(raw, ["x", "y"]).first()
    assert done.x is None and done.cells == ["a", "b", "c"]
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert grid.rename_loosely(df, ["x"]).columns == ["x", "b"]
    assert grid.rename_loosely(df, ["x", "y", "z"]).columns == ["x", "y"]
    assert grid.rename_strictly(df, ["x", "y"]).columns == ["x", "y"]
    with pytest.raises(ValueError):
        grid.rename_strictly(df, ["x"])


def test_keywords(spark, rows):
    df = spark.createDataFrame([("Course Total", 1), ("12.5%", 2), ("MATH-151-501", 3), (None, 4)], "a string, b int")
    assert rows(grid.drop_keyword_rows(df, ["%", "TOTAL"])) == [("MATH-151-501", 3), (None, 4)]
    assert grid.drop_keyword_rows(df, []).count() == 4


def test_header_row(spark, rows):
    df = spark.createDataFrame([(1, "x")], "n int, t string")
    assert rows(grid.header_as_first_row(df, order="n")) == [("-1", "t"), ("1", "x")]
    assert grid.header_as_first_row(df.limit(0)).count() == 0


def test_prepend(spark):
    df = spark.createDataFrame([("CS101", "old")], "Course string, Year string")
    out = sections.prepend_constants(df, ["College", "Year"], ["Engineering", "2023"])
    assert out.columns == ["College", "Course", "Year"] and tuple(out.first()) == ("Engineering", "CS101", "2023")
    empty = sections.prepend_constants(df.limit(0), ["College", "Year"], ["E", 2023])
    assert [tuple(r) for r in empty.collect()] == [("E", 2023)]
    with pytest.raises(ValueError):
        sections.prepend_columns(df, ["a"], [])


def test_whole_chain(spark):
    data = [
        ["MATH-151-501", "5", "1", "", "", "2", "8", "2.75", "", "", "", "1", "0", "9", "DOE J", ""],
        ["Course Total", "5", "1", "", "", "2", "8", "2.75", "", "", "", "1", "0", "9", "", ""],
        ["20.0%", "", "", "", "", "", "", "-------", "", "", "", "", "", "", "", "z"],
    ]
    raw = spark.createDataFrame([("grd_2023_3_EN.pdf", 0, i, c) for i, c in enumerate(data)], schemas.GRID)
    out = sections.clean_sections(grid.grid_to_rows(raw)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.College, r.Year, r.Semester, r.Class_Code, r.Section) == ("Engineering", "2023", "Fall", "MATH-151", "501")
    assert (r.A, r.F, r.Total_A_F, r.GPA, r.B, r.C, r.Total) == (5, 2, 8, 2.75, 1, None, 9)
    assert " " not in out[0].asDict()


def test_for_correlation(spark):
    df = spark.createDataFrame(
        [("501", "1", "16", "20", "2.5", "2020"), ("Course Total", "1", "1", "1", "1", "x"), (None, "0", "0", "0", "-", "Unknown")],
        "Section string, A string, `Total A-F` string, Total string, GPA string, Year string",
    )
    out = {r.Section: r for r in sections.for_correlation(df).collect()}
    assert set(out) == {"501", None}
    assert (out["501"].Pct_A, out["501"].Pct_graded, out["501"].Class_Size, out["501"].Year) == (6.2, 80.0, 20, 2020)
    assert out[None].Pct_A is None and out[None].Year is None and out[None].GPA is None
