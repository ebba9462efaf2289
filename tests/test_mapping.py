import pytest
from pyspark.sql import functions as F

from quire.operators import checks, spans
from quire.sources import files, sqlite
from quire.spec import Edition

LETTERS = "ابتثجحخدذرزسشصضطظعغفقكلمنهو"


def word(k):
    return LETTERS[k % 27] + LETTERS[k * 7 % 27] + LETTERS[k * 11 % 27]


def verse(*ks):
    return " ".join(word(k) for k in ks)


#: The reference's verses, and another edition's: verse 1 left out, merged, split, a lost and an added word.
REFERENCE = [(1, 1, verse(1, 2)), (1, 2, verse(3, 4, 5)), (1, 3, verse(6, 7)), (2, 1, verse(8, 9)), (2, 2, verse(10, 11, 12)), (2, 3, verse(13, 14, 15, 16)), (2, 4, verse(17, 18, 19))]
OTHER = [(1, 1, verse(3, 4, 5)), (1, 2, verse(6, 7)), (2, 1, verse(8, 9, 10, 11, 12)), (2, 2, verse(13, 14)), (2, 3, verse(15, 16)), (2, 4, verse(17, 19, 20))]
EDITIONS = (Edition(1, "r", "r", 7), Edition(2, "o", "o", 6))


def ayat(spark, other=OTHER):
    rows = [(1, *r, 1) for r in REFERENCE] + [(2, *r, 1) for r in other]
    return spark.createDataFrame(rows, "edition_id int, surah int, ayah int, text string, page int")


@pytest.fixture(scope="module")
def mapped(spark):
    rows, bad = spans.map_editions(ayat(spark))
    rows = rows.persist()
    yield rows, bad
    rows.unpersist()


def editions(spark):
    return spark.createDataFrame([(e.edition_id, e.edition_key, e.rawi, e.ayah_count, e.reference) for e in EDITIONS], "edition_id int, edition_key string, rawi string, ayah_count int, reference string")


def counts(spark):
    return spark.createDataFrame([(1, 3), (2, 4)], "surah int, n int")


def test_map(spark, mapped):
    rows, bad = mapped
    got: dict = {}
    for r in rows.collect():
        got.setdefault(tuple(r)[:3], set()).add(r.hafs_ayah)
    assert bad.collect() == []
    assert {k: v for k, v in got.items() if k[0] == 2} == {(2, 1, 1): {2}, (2, 1, 2): {3}, (2, 2, 1): {1, 2}, (2, 2, 2): {3}, (2, 2, 3): {3}, (2, 2, 4): {4}}
    assert all(v == {k[2]} for k, v in got.items() if k[0] == 1)
    assert [r.hafs_ayah for r in spans.references(rows, 2, 2, 1).collect()] == [1, 2]
    assert checks.mapping(rows, editions(spark), counts(spark)).collect() == []
    report = spans.build_report(rows, editions(spark)).first()
    assert (report.row_count, report.multi_reference_ayah_count, len(report.editions)) == (14, 1, 2)


def test_coverage_is_an_option(spark, mapped):
    half, _ = spans.map_editions(ayat(spark), coverage=0.5)
    assert sorted(map(tuple, half.collect())) == sorted(map(tuple, mapped[0].collect()))  # any overlap at all qualifies


def test_verse_without_reference(spark):
    _, bad = spans.map_editions(ayat(spark, [(1, 1, verse(3, 4, 5)), (1, 2, verse(6, 7)), (2, 1, ""), (2, 2, verse(8, 9))]))
    assert [r.key for r in bad.collect()] == ["2:2:1"]


@pytest.mark.parametrize(
    ("change", "rule"),
    [
        (lambda m: m.filter("not (edition_id = 2 and surah = 2 and ayah = 3)"), "mapped_verses"),
        (lambda m: m.filter("not (edition_id = 2 and surah = 2 and hafs_ayah = 4)"), "missing_reference"),
        (lambda m: m.withColumn("hafs_ayah", F.when(F.expr("edition_id = 1 and surah = 2 and ayah = 2"), 3).otherwise(F.col("hafs_ayah"))), "identity"),
        (lambda m: m.withColumn("hafs_ayah", F.when(F.expr("edition_id = 2 and surah = 2 and ayah = 4"), 1).otherwise(F.col("hafs_ayah"))), "reference_order"),
        (lambda m: m.withColumn("hafs_ayah", F.when(F.expr("edition_id = 2 and surah = 2 and ayah = 1 and hafs_ayah = 2"), 4).otherwise(F.col("hafs_ayah"))), "reference_gap"),
        (lambda m: m.union(m.limit(1)), "duplicate_mapping"),
        (lambda m: m.withColumn("edition_id", F.when(F.col("edition_id") == 2, 9).otherwise(F.col("edition_id"))), "orphan_edition"),
    ],
)
def test_violations(spark, mapped, change, rule):
    bad = checks.mapping(change(mapped[0]), editions(spark), counts(spark))
    assert rule in {r.rule for r in bad.collect()}
    with pytest.raises(checks.Violations):
        checks.raise_if_any(bad)


def test_anchors_and_editions(spark, mapped):
    assert checks.mapping_anchors(mapped[0], ((2, 2, 1, (1, 2)), (2, 1, 1, (2,)))).collect() == []
    assert [r.key for r in checks.mapping_anchors(mapped[0], ((2, 2, 1, (1,)), (2, 9, 9, (1,)))).orderBy("key").collect()] == ["2:2:1", "2:9:9"]
    assert checks.editions_equal(editions(spark), EDITIONS).collect() == []
    assert len(checks.editions_equal(editions(spark)).collect()) == 6
    from quire.spec import LayoutSpec

    assert checks.chapter_totals(ayat(spark), LayoutSpec(chapters=2), {1: 7, 2: 6}).collect() == []
    assert {r.rule for r in checks.chapter_totals(ayat(spark), LayoutSpec(chapters=3), {1: 7, 2: 5}).collect()} == {"missing_chapter", "verse_total"}


def test_relations(spark, mapped, tmp_path):
    path, data = str(tmp_path / "m.sqlite"), {"metadata": files.metadata_rows(spark, {"schema_version": 1}), "editions": editions(spark), "ayah_hafs_map": mapped[0]}
    assert sqlite.export(path, data) == 17
    assert sqlite.intact(path) and sqlite.tables(path) == ["ayah_hafs_map", "editions", "metadata"]
    back = sqlite.read(spark, path, "ayah_hafs_map", "edition_id int, surah int, ayah int, hafs_ayah int")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, mapped[0].collect()))
    assert sqlite.read(spark, path, "editions").count() == 2
    files.write_relations(str(tmp_path / "out"), data["metadata"], data["editions"], mapped[0])
    assert spark.read.parquet(str(tmp_path / "out/ayah_hafs_map")).count() == 14


def test_sqlite_partitions(spark, tmp_path):
    import sqlite3

    path = str(tmp_path / "q.sqlite")
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE ayat (surah INT, ayah INT, text TEXT, page INT)")
    con.executemany("INSERT INTO ayat VALUES (?, ?, ?, ?)", [(1, k, f"t{k}", 1) for k in range(1, 101)])
    con.commit()
    con.close()
    rows = sqlite.read(spark, path, "ayat", partitions=7)
    assert rows.rdd.getNumPartitions() == 7 and rows.count() == 100 and rows.select("text").distinct().count() == 100


def test_columns_and_filters_reach_the_file(spark, tmp_path):
    import sqlite3

    path = str(tmp_path / "t.sqlite")
    with sqlite3.connect(path) as con:
        con.execute("CREATE TABLE t (a INTEGER, b TEXT, c REAL)")
        con.executemany("INSERT INTO t VALUES (?, ?, ?)", [(k, f"x{k % 3}", k / 2) for k in range(50)] + [(None, None, None)])
    rows = sqlite.read(spark, path, "t", columns=["a", "b"], partitions=3)
    assert rows.columns == ["a", "b"]
    picked = rows.filter("a >= 10 and b = 'x1' and a in (10, 13, 14, 40)")
    assert sorted(map(tuple, picked.collect())) == [(10, "x1"), (13, "x1"), (40, "x1")]
    assert rows.filter("a is null").count() == 1 and rows.filter("b is not null and a < 5").count() == 5
    reader = sqlite.SqliteReader({"path": path, "table": "t"}, rows.schema)
    assert list(reader.pushFilters([sqlite.EqualTo(("b",), "x1"), sqlite.GreaterThan(("a",), 40)])) == []
    assert sorted(reader.read(sqlite.KeyRange())) == [(43, "x1"), (46, "x1"), (49, "x1")]
