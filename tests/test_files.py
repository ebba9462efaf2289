import json
import os

import pytest
from pyspark.sql import functions as F

from quire.operators import pages
from quire.plans import layout
from quire.sources import files

from . import mini


def test_lines_of_many_splits(spark, tmp_path):
    """Numbers go on over splits and files; ends of lines are those of the whole text."""
    text = "".join(f"line {k} é漢{['\n', '\r\n', '\x0b', ' ', '\x85', '\n\n'][k % 6]}" for k in range(4000)) + "last"
    (tmp_path / "a.txt").write_bytes(text.encode())
    (tmp_path / "b.txt").write_text("next\nfile\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = files.printed_lines(spark, str(tmp_path), 7)
        assert files.stretches(spark, str(tmp_path)).rdd.getNumPartitions() > 10
        got = sorted((r.line_no, r.text) for r in df.collect())
        assert got == list(enumerate([*text.splitlines(), "next", "file"]))
        assert {r.edition_id for r in df.select("edition_id").distinct().collect()} == {7}
        tagged = "".join(f"<p>{k}</p>\n" + ("<beginpage/>" * (k % 7 == 6) + "x\n" * (k % 2)) + "<beginpage/><beginpage/>" * (k % 500 == 499) for k in range(3000)) + "<BEGINPAGE/>end"
        (tmp_path / "c.xml").write_text(tagged)
        segments = files.page_segments(spark, str(tmp_path / "c.xml"), 1)
        assert [r.xml for r in segments.orderBy("segment_no").collect()] == tagged.split("<beginpage/>")
        assert [r.segment_no for r in segments.orderBy("segment_no").collect()] == list(range(1, len(tagged.split("<beginpage/>")) + 1))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_no_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("")
    assert files.printed_lines(spark, str(tmp_path / "a.txt"), 1).collect() == []


def test_a_build_from_files(spark, tmp_path):
    lines, segments = mini.sources(spark, joined=(3,))
    (tmp_path / "t.txt").write_text("\n".join(r.text for r in lines.orderBy("line_no").collect()) + "\n")
    (tmp_path / "t.xml").write_text("<beginpage/>".join(r.xml for r in segments.orderBy("segment_no").collect()))
    printed, bad = pages.printed_pages(files.printed_lines(spark, str(tmp_path / "t.txt"), 1), files.page_segments(spark, str(tmp_path / "t.xml"), 1), mini.SPEC)
    assert sorted(map(tuple, printed.collect())) == sorted(map(tuple, mini.printed(spark).collect())) and bad.collect() == []


def tree(folder):
    return {os.path.relpath(os.path.join(d, n), folder): open(os.path.join(d, n), "rb").read() for d, _, names in os.walk(folder) for n in names}


@pytest.fixture(scope="module")
def built(spark):
    out = layout.build(mini.printed(spark), mini.ayat(spark), mini.SPEC)
    yield out
    out.release()


def test_sets_replace_each_other_whole(spark, built, tmp_path):
    folder = str(tmp_path / "set")
    totals = files.export_layout(built.pages, built.surahs, {"v": 1}, folder)
    assert totals == {"pages": 4, "lines": 10, "surahs": 3}
    first = tree(folder)
    assert len(first) == 8 and json.loads(first["manifest.json"]) == {"v": 1}
    # a task that fails, and two records of one name
    lost = built.pages.withColumn("page", F.when(F.col("page") == 3, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("page")))
    for bad in (lost, built.pages.union(built.pages)):
        with pytest.raises(Exception):  # noqa: B017  Spark's own
            files.export_layout(bad, built.surahs, {"v": 2}, folder)
        assert tree(folder) == first and os.listdir(tmp_path) == ["set"]
    files.export_layout(built.pages.filter("page < 3"), built.surahs, {"v": 3}, folder)
    assert sorted(tree(folder)) == ["manifest.json", "pages/page_001.json", "pages/page_002.json", "surahs/001.json", "surahs/002.json", "surahs/003.json"]
    assert os.listdir(tmp_path) == ["set"]


def test_attempts_that_do_not_count_are_left_out(tmp_path):
    writer = files.RecordWriter(str(tmp_path / "r"))
    one = writer.write(iter([("a", "{}"), ("b", "{}")]))
    again = writer.write(iter([("a", '{"late": 1}')]))
    assert again.folder != one.folder and not os.path.exists(tmp_path / "r")
    writer.commit([one, None, writer.write(iter([]))])
    assert tree(tmp_path) == {"r/a": b"{}\n", "r/b": b"{}\n"}


def test_summary(spark, built):
    said = []
    files.sample_pages(built.pages, files.DOCUMENT_PAGES, said.append, {"pages": 4, "surahs": 3})
    assert said[0] == "pages: 4, surahs: 3" and [s.split(":")[0] for s in said[1:]] == ["page 1", "page 2"]
