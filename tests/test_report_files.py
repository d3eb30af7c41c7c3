"""Report files as a source: listing, conditions, streams, and writing."""

import pytest
from pyspark.sql import functions as F

from cohortlens.sources.report_files import Batch, listing, register


@pytest.fixture
def folder(spark, tmp_path):
    register(spark)
    rows = [(t, y, s, c, f"{t}{y}{s}{c}".encode()) for t in ("grd", "gpac") for y in (2019, 2020, 2021) for s in (1, 3) for c in ("EN", "MD_PROF")]
    df = spark.createDataFrame(rows, "report_type string, year int, semester int, college string, content binary")
    df.write.format("report_files").mode("append").save(str(tmp_path / "in"))
    (tmp_path / "in" / "notes.txt").write_text("no report")
    (tmp_path / "in" / "grd_20_1_EN.txt").write_text("no year")
    return str(tmp_path / "in")


def test_files_and_contents_come_back(spark, folder):
    found = spark.read.format("report_files").option("content", "true").option("partitionBytes", 40).load(folder)
    assert found.rdd.getNumPartitions() > 4
    got = found.collect()
    assert len(got) == 24
    for r in got:
        assert bytes(r["content"]).decode() == f"{r['report_type']}{r['year']}{r['semester']}{r['college']}"
        assert r["length"] == len(r["content"]) and r["path"].endswith(f"_{r['college']}.txt")


def test_options_are_settled_at_the_listing(spark, folder):
    options = {"firstYear": "2020", "colleges": "EN, XX", "reportTypes": "grd"}
    few = spark.read.format("report_files").options(content="true", **options).load(folder)
    assert sorted((r["year"], r["semester"], r["college"]) for r in few.collect()) == [(y, s, "EN") for y in (2020, 2021) for s in (1, 3)]
    # A file that is excluded is not even planned to be opened.
    slices = Batch({"path": folder, "content": "true", **options}).partitions()
    assert {r[1:3] + r[4:5] for p in slices for r in p.rows} == {("grd", 2020, "EN"), ("grd", 2021, "EN")}


def test_two_branches_with_unlike_conditions(spark, folder):
    files = spark.read.format("report_files").load(folder)
    both = files.where("year < 2020").unionByName(files.where("year >= 2020"))
    assert both.count() == 24 and both.where("year < 2020").count() == 8


def test_stream_takes_every_file_once_over_restarts(spark, folder, tmp_path):
    def take():
        stream = spark.readStream.format("report_files").option("content", "true").load(folder)
        stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).option("path", str(tmp_path / "out")).trigger(
            availableNow=True).start().awaitTermination()
        return spark.read.parquet(str(tmp_path / "out")).count()

    assert take() == 24
    assert take() == 24
    more = spark.createDataFrame([("grd", 2022, 2, "SC", b"late")], "report_type string, year int, semester int, college string, content binary")
    more.write.format("report_files").mode("append").save(folder)
    assert take() == 25
    assert spark.read.parquet(str(tmp_path / "out")).where("year = 2022").first()["college"] == "SC"


def test_no_folder_nulls_and_repeated_names(spark, folder, tmp_path):
    none = str(tmp_path / "none")
    assert listing(none) == [] and spark.read.format("report_files").load(none).count() == 0
    schema = "report_type string, year int, semester int, college string, content binary"
    spark.createDataFrame([("grd", 2019, 1, "EN", None)], schema).write.format("report_files").mode("append").save(folder)
    files = spark.read.format("report_files").load(folder)
    assert files.count() == 24 and files.where(F.col("length") == 0).count() == 1
    with pytest.raises(Exception, match="not the name of a report file"):
        spark.createDataFrame([("grd", None, 1, "EN", b"")], schema).write.format("report_files").mode("append").save(folder)
    assert spark.read.format("report_files").load(folder).count() == 24
