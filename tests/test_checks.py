import os

import pytest
from pyspark.sql import functions as F

from quire.operators import checks, rollup, words
from quire.plans import layout
from quire.sources import files
from quire.spec import LayoutSpec

from . import mini

#: A folder of sample layouts, if there is one: an edition each, and tables of counts.
GOLDEN = os.environ.get("QUIRE_SAMPLES", "")
GIVEN = {"hafs": 540, "douri": 539, "warsh": 240, "qalun": 149}


@pytest.fixture(scope="module")
def built(spark):
    out = layout.build(mini.printed(spark), mini.ayat(spark), mini.SPEC)
    pages, surahs, stream = out.pages.persist(), out.surahs.persist(), words.words(mini.ayat(spark)).persist()
    yield pages, surahs, stream
    for df in (pages, surahs, stream):
        df.unpersist()


def changed(pages, page, f):
    """Page records with one page's lines changed."""
    return pages.withColumn("lines", F.when(F.col("page") == page, f(F.col("lines"))).otherwise(F.col("lines")))


def first(field, value):
    return lambda lines: F.transform(lines, lambda x, i: F.when(i == 0, x.withField(f"first_word.{field}", F.lit(value))).otherwise(x))


def end(field, value):
    return lambda lines: F.transform(lines, lambda x: x.withField(f"end_word.{field}", F.lit(value)))


@pytest.mark.parametrize(
    ("change", "rule"),
    [
        (lambda p: p.filter("page <> 2"), "missing_page"),
        (lambda p: p.filter("page <> 2"), "page_count"),
        (lambda p: p.filter("page <> 2"), "continuity"),
        (lambda p: p.withColumn("page", F.when(F.col("page") == 4, 9).otherwise(F.col("page"))), "extra_page"),
        (lambda p: changed(p, 1, lambda x: F.slice(x, 1, 0)), "page_lines"),
        (lambda p: changed(p, 2, lambda x: F.transform(x, lambda y: y.withField("line", y["line"] + 1))), "line_numbers"),
        (lambda p: changed(p, 2, first("ayah", 99)), "endpoint_verse"),
        (lambda p: changed(p, 2, first("wordIndex", 99)), "word_index"),
        (lambda p: changed(p, 2, first("word", "other")), "word_text"),
        (lambda p: changed(p, 2, first("type", "letter")), "endpoint_type"),
        (lambda p: changed(p, 2, lambda x: F.transform(x, lambda y: y.withField("first_word.wordIndex", F.lit(None).cast("int")))), "endpoint_fields"),
        (lambda p: changed(p, 3, end("number", 3)), "marker_number"),
        (lambda p: changed(p, 4, lambda x: F.slice(x, 1, 2)), "last_word"),
        (lambda p: changed(p, 1, lambda x: F.transform(x, lambda y: y.withField("first_word", F.element_at(x, -1)["first_word"]))), "line_backwards"),
    ],
)
def test_each_rule(spark, built, change, rule):
    pages, surahs, stream = built
    assert rule in {r.rule for r in checks.layout(change(pages), surahs, stream, mini.SPEC).select("rule").distinct().collect()}


def test_clean(built):
    pages, surahs, stream = built
    assert checks.layout(pages, surahs, stream, mini.SPEC).collect() == []
    assert checks.present_continuity(rollup.lines_of_pages(pages)).collect() == []


def test_other_rules(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    have = files.digests(spark, str(tmp_path / "a.txt"))
    assert have.first().sha256 == "2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881"
    want = spark.createDataFrame([("a.txt", "no"), ("b.txt", "no")], "name string, sha256 string")
    assert {r.rule for r in checks.digests(have, want).collect()} == {"digest", "missing_source"}
    lines = spark.createDataFrame([('{"line":1,"first_word":{},"end_word":{}}',), ('{"line":1}',)], "json string")
    assert len(checks.line_keys(lines).collect()) == 1
    df = spark.createDataFrame([(3, "docx", 1, 2)], "schema_version int, layout_source string, total_pages int, total_surahs int")
    assert {r.rule for r in checks.manifest(df, LayoutSpec()).collect()} == {"manifest_layout_source", "manifest_total_pages", "manifest_total_surahs"}
    df.createOrReplaceTempView("there")
    assert [r.key for r in checks.required_tables(spark, ["there", "gone"]).collect()] == ["gone"]
    assert [r.key for r in checks.required_columns(df, {"schema_version": "int", "x": "int"}, "t").collect()] == ["t.x"]
    early = mini.ayat(spark, [(1, 1, None, 1), (1, 2, "a", 9)])
    assert {r.rule for r in checks.source_verses(early, LayoutSpec(pages=2)).collect()} == {"null_text"}
    assert {r.rule for r in checks.source_verses(early, LayoutSpec(pages=2, printed_marker=True, null_text=True)).collect()} == {"page_range", "missing_page"}


def test_stream_of_pages(spark, tmp_path):
    from quire import schema as S
    from quire.streaming import watch

    bad = spark.range(1).select(F.lit(3).alias("schema_version"), F.lit(1).alias("page"), F.array().cast("array<int>").alias("surah_ids"), F.lit("").alias("font_family"), F.lit("").alias("layout_source"), F.array().cast(f"array<{S.LINE}>").alias("lines"))
    bad.write.parquet(str(tmp_path / "in"))
    seen = []
    pages = spark.readStream.schema(bad.schema).parquet(str(tmp_path / "in")).withColumn("edition_id", F.lit(1))
    q = watch(pages, LayoutSpec(), lambda df, n: seen.extend(df.collect()), str(tmp_path / "cp"))
    q.processAllAvailable()
    q.stop()
    assert [r.rule for r in seen] == ["page_lines"]


@pytest.mark.skipif(not os.path.isdir(GOLDEN), reason="no sample layouts here")
@pytest.mark.parametrize("edition", GIVEN)
def test_sample_layouts(spark, edition):
    pages = files.pages(spark, f"{GOLDEN}/{edition}/pages", 1).persist()
    lines = rollup.lines_of_pages(pages).persist()
    assert lines.count() == GIVEN[edition]
    assert checks.present_continuity(lines).collect() == []
    assert lines.filter("first_word.type <> 'word' or (end_word.type = 'ayah_marker' and end_word.number <> end_word.ayah) or first_word.surah <> end_word.surah").count() == 0
    numbers = F.transform("lines", lambda x: x["line"])
    assert pages.filter(numbers != F.sequence(F.lit(1), F.size("lines"))).count() == 0
    surahs = rollup.lines_of_chapters(files.surahs(spark, f"{GOLDEN}/{edition}/surahs", 1))
    both = surahs.select("surah", "page", "line").join(lines.select(F.col("first_word.surah").alias("surah"), "page", "line"), ["surah", "page", "line"])
    shared = lines.select("page").distinct()
    assert both.count() == surahs.join(shared, "page", "left_semi").count()


@pytest.mark.skipif(not os.path.isdir(GOLDEN), reason="no sample layouts here")
def test_count_tables(spark):
    for system in ("kufi", "basri", "madani-first", "madani-last", "warsh-6213"):
        row = files.counts(spark, f"{GOLDEN}/ayah_mapping/surah-counts/{system}.json").groupBy("total").agg(F.sum("n").alias("n"), F.count("*").alias("chapters")).first()
        assert row.total == row.n and row.chapters == 114
    assert "_deprecated" not in files.rawis(spark, f"{GOLDEN}/ayah_mapping/rawis/hafs.json").first().fields
