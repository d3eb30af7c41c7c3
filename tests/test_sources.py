from pyspark.sql import types as T

from cohortlens import schemas
from cohortlens.operators import reports
from cohortlens.operators import sections as sec
from cohortlens.sources import files, tables
from cohortlens.streaming import ingest

SECTION_ROWS = [
    ("Engineering", "2023", "Fall", "MATH-151", "501", 300, 3.5), ("Science", "Unknown", "Fall", "CHEM-1", None, 250, 2.5),
    ("Engineering", "2022", "Fall", "MATH-151", "502", 10, None),
]
SECTION_SCHEMA = "College string, Year string, Semester string, Class_Code string, Section string, Total bigint, GPA double"


def test_tables(spark, rows):
    first = spark.createDataFrame([(1, "x")], "a int, b string")
    second = spark.createDataFrame([("2", 9.0), ("q", 9.0)], "a string, extra double")
    assert not tables.table_exists(spark, "t_append") and tables.row_count(spark, "t_append") == -1
    assert tables.read_or_empty(spark, "t_append", schemas.COURSE_GPA).schema == schemas.COURSE_GPA
    assert tables.append_aligned(first.limit(0), "t_append") is False
    assert tables.append_aligned(first, "t_append") and tables.append_aligned(second, "t_append")
    assert tables.append_aligned(first, "t_append")
    assert rows(spark.table("t_append")) == [(1, "x"), (1, "x"), (2, None), (None, None)]
    assert tables.row_count(spark, "t_append") == 4 and tables.column_names(spark, "t_append") == ["a", "b"]
    assert tables.replace_table(second, "t_append") and tables.column_names(spark, "t_append") == ["a", "extra"]
    assert tables.has_columns(first, ["a"]) and not tables.has_columns(first, ["a", "z"])


def test_partitioned_round_trip(spark, tmp_path, rows):
    s = spark.createDataFrame(SECTION_ROWS, SECTION_SCHEMA)
    path = str(tmp_path / "out")
    assert tables.export_sections(s, path)
    assert (tmp_path / "out" / "College=Engineering" / "Year=2022" / "Semester=Fall").is_dir()
    assert rows(files.read_partitioned(spark, path, s.schema)) == rows(s)
    # Only the partitions at hand are replaced.
    assert tables.export_sections(s.limit(1), path)
    assert files.read_partitioned(spark, path, s.schema).count() == 3
    assert tables.export_sections(s.limit(0), path) is False


def test_manifest_and_pages(spark, tmp_path, rows):
    for name, size in [("b.PDF", 5), ("a.pdf", 3000), ("c.txt", 9)]:
        (tmp_path / name).write_bytes(b"x" * size)
    assert [(r.name, r.length) for r in files.file_manifest(spark, str(tmp_path)).collect()] == [("a.pdf", 3000), ("b.PDF", 5)]
    (tmp_path / "biology___bs.html").write_text("<p>one\ntwo</p>")
    (tmp_path / "empty.html").write_text("")
    cached = files.cached_pages(spark, str(tmp_path))
    sources = spark.createDataFrame([("Biology - BS",), ("Empty",), ("Gone",)], "major string")
    assert rows(files.pages_of(sources, cached)) == [("Biology - BS", "<p>one\ntwo</p>")]
    assert rows(files.pages_to_fetch(sources, cached)) == [("Empty",), ("Gone",)]


def test_reports(spark, tmp_path):
    s = spark.createDataFrame(
        [r + (1, 20, 0, 0) for r in SECTION_ROWS], SECTION_SCHEMA + ", F bigint, Total_A_F bigint, Q bigint, X bigint"
    )
    plan = spark.createDataFrame(
        [("M", "course", None, 0, "MATH", "151", "t", 3.0), ("M", "choice_header", 1, 1, None, None, "Select", 2.0),
         ("M", "choice_option", 1, 2, "CHEM", "1", "c", None), ("N", "course", None, 0, "CHEM", "1", "c", 3.0)],
        "major string, row_type string, choice_group_id bigint, row_order int, course_subject string, course_number string,"
        " title string, credit_hours double",
    )
    reports.export_all(plan, s, str(tmp_path))
    reports.register_views(spark, str(tmp_path), s.schema, plan.schema)
    got = {name: reports.report(spark, name).collect() for name in [*reports.REPORTS, *reports.LIVE]}
    assert [r.major for r in got["expected_gpa"]] == ["M", "N"]
    assert got["kpis"][0].total_grade_rows == 2 and got["kpis"][0].latest_year == 2023
    assert got["hardest_courses"][0].class_code == "CHEM-1" and got["easiest_courses"][0].class_code == "MATH-151"
    assert [(r.Year, r.weighted_gpa) for r in got["yearly_trend"]] == [(2023, 3.5)]
    assert len(got["difficulty_index"]) == 2 and got["optimizer_selections"][0].course_subject == "CHEM"
    assert {r.major: r.gpa_uplift for r in got["optimizer_comparison"]} == {"M": 0.0, "N": 0.0}
    reports.create_tables(spark, "lens_test", {"sections": s})
    assert spark.table("lens_test.sections").count() == 3


def test_correlation_report(spark):
    data = [(f"S{i % 3}", "Fall", i % 7, 10 + i % 7, 20, 2.0 + (i % 7) / 10, str(500 + i), f"T{i % 4}") for i in range(60)]
    s = spark.createDataFrame(
        data, "College string, Semester string, A bigint, Total_A_F bigint, Total bigint, GPA double, Section string, Instructor string"
    )
    out = reports.correlation_report(s, ["A", "GPA", "Total_A_F"], ["College", "Instructor"])
    assert {r.r for r in out["spearman"].collect()} == {1.0}
    assert out["top_pairs"].count() == 0 and out["phik"].count() == 10 and out["instructors"].count() == 4
    assert out["associations"].count() == 20


def test_stream_takes_each_file_once(spark, tmp_path, rows):
    raw = T.StructType([T.StructField(c, T.StringType()) for c in ["source_file", "Section", "GPA", "Total"]])
    target = T.StructType([T.StructField("College", T.StringType()), T.StructField("Class_Code", T.StringType()),
                           T.StructField("GPA", T.DoubleType()), T.StructField("Instructor", T.StringType())])

    def drop(name, *data):
        spark.createDataFrame(data, raw).write.parquet(str(tmp_path / "in" / name))

    def run():
        return ingest.ingest_files(
            spark, str(tmp_path / "in" / "*"), raw, sec.clean_sections, target,
            str(tmp_path / "out"), str(tmp_path / "cp"), files_per_batch=1,
        )

    drop("one", ("grd_2023_3_EN.pdf", "MATH-151-501", "3.5", "10"))
    assert rows(run()) == [("Engineering", "MATH-151", 3.5, None)]
    drop("two", ("grd_2023_3_SC.pdf", "CHEM-1-501", "-------", "5"))
    expected = [("Engineering", "MATH-151", 3.5, None), ("Science", "CHEM-1", None, None)]
    assert rows(run()) == expected and rows(run()) == expected


def test_broken_files_are_reported_and_taken_never(spark, tmp_path, rows):
    raw = T.StructType([T.StructField(c, T.StringType()) for c in ["source_file", "Section", "GPA", "Total"]])
    target = T.StructType([T.StructField("Class_Code", T.StringType()), T.StructField("GPA", T.DoubleType())])
    data = [("grd_2023_3_EN.pdf", f"MATH-{i}-501", "3.5", "10") for i in range(3000)]
    folder = tmp_path / "in"
    spark.createDataFrame(data, raw).coalesce(1).write.parquet(str(folder))
    (good,) = folder.glob("part-*.parquet")
    whole = good.read_bytes()
    (folder / "short.parquet").write_bytes(whole[: len(whole) // 2])  # no footer
    middle = bytearray(whole)
    middle[200:len(whole) // 2] = b"x" * (len(whole) // 2 - 200)  # a footer over spoiled pages
    (folder / "spoiled.parquet").write_bytes(bytes(middle))
    taken = ingest.ingest_files(spark, str(folder), raw, sec.clean_sections, target, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert taken.count() == 3000 and taken.select("Class_Code").distinct().count() == 3000
    bad = {r.path.rsplit("/", 1)[1]: (r.length, r.reason) for r in ingest.rejected_files(spark, str(tmp_path / "out")).collect()}
    assert bad == {"short.parquet": (len(whole) // 2, "unreadable"), "spoiled.parquet": (len(whole), "damaged")}


def test_the_history_of_running_means_is_compacted(spark, tmp_path):
    schema = "key string, v double, w bigint"

    def drop(name, *data):
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "in" / name))

    def run():
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "*"))
        out = ingest.running_mean(stream, "key", "v", "w", str(tmp_path / "out"), str(tmp_path / "cp"))
        return {r.key: (r["mean"], r.weight, r.n) for r in out.collect()}

    drop("a", ("x", 1.0, 1), ("y", 5.0, 2))
    assert run() == {"x": (1.0, 1, 1), "y": (5.0, 2, 1)}
    drop("b", ("x", 4.0, 2))
    drop("c", ("z", 0.0, 0))
    want = {"x": (3.0, 3, 2), "y": (5.0, 2, 1), "z": (None, 0, 1)}
    assert run() == want and run() == want
    assert len(list((tmp_path / "out").glob("batch=*"))) == 1


def test_many_majors_share_folders(spark, tmp_path, monkeypatch):
    """Above a number of majors folders are shared; still only the majors at hand are replaced, and older folders move in."""
    from cohortlens.sources import files, tables

    def names(path):
        return sorted(p.name.split("=")[0] for p in path.iterdir() if p.is_dir())

    def plan(*rows):
        return spark.createDataFrame(rows, "major string, hours int")

    def back():
        return sorted(map(tuple, files.read_partitioned(spark, str(path), plan(("A", 1)).schema).collect()), key=repr)

    path = tmp_path / "plans"
    assert tables.export_plan_rows(plan(("A", 1), ("A", 2), ("B", 3)), str(path))
    assert names(path) == ["major", "major"]
    monkeypatch.setattr(tables, "MAJOR_FOLDERS", 2)
    monkeypatch.setattr(tables, "MAJOR_PARTS", 2)
    assert tables.export_plan_rows(plan(*((m, 7) for m in "BCDE")), str(path))
    assert set(names(path)) == {"major_part"} and len(names(path)) <= 2
    assert back() == [("A", 1), ("A", 2), ("B", 7), ("C", 7), ("D", 7), ("E", 7)]
    assert tables.export_plan_rows(plan(("C", 8), (None, 9)), str(path))
    assert not tables.export_plan_rows(plan(("C", 8)).limit(0), str(path))
    assert back() == [("A", 1), ("A", 2), ("B", 7), ("C", 8), ("D", 7), ("E", 7), (None, 9)]
    assert tables.export_plan_rows(plan((None, 1)), str(path)) and (None, 9) not in back()
