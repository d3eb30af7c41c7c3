"""Cached pages as a source: listing, text, streams, and writing."""

import os

import pytest

from cohortlens.sources.page_files import listing, newest, register

SCHEMA = "stem string, html string"


@pytest.fixture
def folder(spark, tmp_path):
    register(spark)
    rows = [("physics", "<p>caf\u00e9 \U0001d4d0</p>"), ("art_history", "<p>\n two\r\nlines</p>"), ("empty", ""), ("none", None), ("long", "x" * 200_000)]
    spark.createDataFrame(rows, SCHEMA).write.format("page_files").mode("append").save(str(tmp_path / "cache"))
    return str(tmp_path / "cache")


def pages(spark, folder, **options):
    return spark.read.format("page_files").options(content="true", **options).load(folder)


def test_pages_come_back_whole(spark, folder):
    (open(os.path.join(folder, "broken.html"), "wb")).write(b"a\xffb")
    open(os.path.join(folder, "touched.html"), "w").close()
    open(os.path.join(folder, "notes.txt"), "w").write("no page")
    found = {r["stem"]: r["html"] for r in pages(spark, folder, partitionBytes="20").collect()}
    assert found == {"physics": "<p>caf\u00e9 \U0001d4d0</p>", "art_history": "<p>\n two\r\nlines</p>", "long": "x" * 200_000, "broken": "a\ufffdb"}
    assert sorted(os.listdir(folder)) == ["art_history.html", "broken.html", "long.html", "notes.txt", "physics.html", "touched.html"]


def test_listing_alone_has_no_text(spark, folder):
    listed = spark.read.format("page_files").load(folder)
    assert listed.columns == ["path", "stem", "length", "modified"]
    assert {r["stem"]: r["length"] for r in listed.collect()}["physics"] == len("<p>caf\u00e9 \U0001d4d0</p>".encode())
    assert listing(folder + "_none") == [] and pages(spark, folder + "_none").count() == 0


@pytest.mark.parametrize("stem", [None, "", "a/b", ".hidden"])
def test_stems_that_are_no_file_name_are_refused(spark, folder, stem):
    with pytest.raises(Exception, match="not the stem of a page"):
        spark.createDataFrame([(stem, "x")], SCHEMA).write.format("page_files").mode("append").save(folder)
    assert len(listing(folder)) == 3


def test_stream_takes_a_page_that_is_fetched_again(spark, folder, tmp_path):
    def take():
        stream = spark.readStream.format("page_files").option("content", "true").load(folder)
        stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).option("path", str(tmp_path / "out")).trigger(
            availableNow=True).start().awaitTermination()
        return spark.read.parquet(str(tmp_path / "out"))

    assert take().count() == 3
    assert take().count() == 3
    spark.createDataFrame([("physics", "<p>new</p>"), ("music", "<p>m</p>"), ("long", "")], SCHEMA).write.format("page_files").mode(
        "append").save(folder)
    taken = take()
    assert taken.count() == 5
    found = {r["stem"]: r["html"] for r in newest(taken).collect()}
    assert found["physics"] == "<p>new</p>" and found["music"] == "<p>m</p>" and len(found["long"]) == 200_000 and len(found) == 4
