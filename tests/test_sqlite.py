import sqlite3

import pytest
from pyspark.sql import functions as F

from quire.sources import files, sqlite


def made(path, *statements):
    con = sqlite3.connect(path)
    for s in statements:
        con.execute(s)
    con.commit()
    con.close()
    return str(path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_filters_are_spark_s_own(spark, tmp_path):
    """Whatever the column's collation, affinity or encoding."""
    path = made(tmp_path / "a.sqlite", "CREATE TABLE t (a INTEGER, b TEXT COLLATE NOCASE, c NUMERIC, d VARCHAR(9), e TEXT COLLATE RTRIM, f REAL)", "INSERT INTO t VALUES (1, 'abc', 5, 'x', 'r', 1.5), (2, 'ABC', '5.0', 'X', 'r  ', 2), (3, NULL, 'five', NULL, NULL, NULL), (NULL, 'b', 7.5, 'y', 's', 0)")
    df = sqlite.read(spark, path, "t")
    whole = spark.createDataFrame(df.collect(), df.schema)
    assert whole.schema["c"].dataType.simpleString() == "string" and {r.c for r in whole.collect()} == {"5", "7.5", "five"}
    for condition in ("b = 'ABC'", "b > 'ABC'", "b <= 'ABC'", "b in ('abc', 'x')", "b is null", "c = '5.0'", "c = '5'", "c < '6'", "d = 'X'", "e = 'r'", "e in ('r  ')", "a = 2", "a >= 2", "a in (1, 3)", "a = 2.0", "f = 2", "f > 1", "a is not null and b = 'abc'", "not (b = 'abc')"):
        assert rows(df.filter(condition)) == rows(whole.filter(condition)), condition
    assert "b COLLATE BINARY" in sqlite.condition(sqlite.EqualTo(("b",), "x"), sqlite.Table.of(path, "t"), {"b": "string"})[0].replace('"', "")


def test_texts_of_another_encoding(spark, tmp_path):
    path = made(tmp_path / "u.sqlite", "PRAGMA encoding = 'UTF-16le'", "CREATE TABLE t (b TEXT)", "INSERT INTO t VALUES ('Ā'), ('ÿ'), ('\U00010000'), ('￮'), ('a')")
    df = sqlite.read(spark, path, "t")
    for condition in ("b > 'ÿ'", "b < 'Ā'", "b >= '￮'", "b = 'Ā'"):
        assert rows(df.filter(condition)) == rows(spark.createDataFrame(df.collect(), df.schema).filter(condition)), condition


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_ranges_of_any_key(spark, tmp_path, parts):
    path = made(
        tmp_path / "k.sqlite",
        "CREATE TABLE w (a TEXT COLLATE NOCASE, b INTEGER, c TEXT, PRIMARY KEY (a, b DESC)) WITHOUT ROWID",
        "WITH RECURSIVE s(v) AS (SELECT 1 UNION ALL SELECT v + 1 FROM s WHERE v < 40) INSERT INTO w SELECT CASE v % 3 WHEN 0 THEN 'x' WHEN 1 THEN 'Y' ELSE 'z' END, v, 'c' || v FROM s",
        "CREATE TABLE r (rowid TEXT, v INTEGER)",
        "WITH RECURSIVE s(v) AS (SELECT 1 UNION ALL SELECT v + 1 FROM s WHERE v < 30) INSERT INTO r SELECT 'n' || v, v * v FROM s",
        "CREATE TABLE one (id INTEGER PRIMARY KEY, v TEXT)",
        "INSERT INTO one VALUES (-5, 'a'), (7, 'b'), (9223372036854775807, 'c')",
        "CREATE TABLE none (a INTEGER PRIMARY KEY) WITHOUT ROWID",
        "CREATE VIEW seen AS SELECT v FROM r",
    )
    con = sqlite3.connect(path)
    for name in ("w", "r", "one", "none", "seen"):
        df = sqlite.read(spark, path, name, partitions=parts)
        assert rows(df) == sorted(con.execute(f"SELECT * FROM {name}").fetchall(), key=repr), name
    assert sqlite.read(spark, path, "w", partitions=4).rdd.getNumPartitions() == 4
    assert [len(p) for p in sqlite.read(spark, path, "w", partitions=4).rdd.glom().collect()] == [10] * 4
    assert rows(sqlite.read(spark, path, "w", partitions=parts).filter("a = 'Y' and b > 20").select("b")) == [(b,) for b in range(22, 41, 3)]
    con.close()


def test_write_and_append(spark, tmp_path):
    path = str(tmp_path / "w.sqlite")
    df = spark.range(1000).select("id", F.concat(F.lit("t"), "id").alias("text"), (F.col("id") / 4).alias("x"), F.lit(None).cast("string").alias("none"), F.lit("2020-02-03").cast("date").alias("day"), F.lit("1.50").cast("decimal(5,2)").alias("price"))
    sqlite.write(df.repartition(7), path, "t", keys=["id"])
    back = sqlite.read(spark, path, "t", partitions=5)
    assert rows(back) == rows(df.withColumn("day", F.col("day").cast("string")).withColumn("price", F.col("price").cast("string")))
    sqlite.write(df.limit(10), path, "t", mode="append")
    sqlite.write(spark.range(3).toDF("k"), path, "other")
    assert sqlite.read(spark, path, "t").count() == 1010 and sqlite.tables(path) == ["other", "t"]
    sqlite.write(df.filter("id < 5"), path, "t")
    assert sqlite.read(spark, path, "t").count() == 5 and sqlite.read(spark, path, "other").count() == 3
    sqlite.write(df.filter("id < 0"), path, "t")
    assert sqlite.read(spark, path, "t").count() == 0 and [p.name for p in tmp_path.iterdir()] == ["w.sqlite"]


def test_failures_leave_the_old_file(spark, tmp_path):
    path = str(tmp_path / "w.sqlite")
    sqlite.write(spark.range(20).toDF("k"), path, "t", "CREATE TABLE t (k INTEGER PRIMARY KEY)", ["k"])
    before = (tmp_path / "w.sqlite").read_bytes()
    broken = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("k"))
    # a failed task; a key twice in one task; a key twice in two tasks; an old key again
    twice = spark.range(10).union(spark.range(10)).toDF("k")
    for bad, mode in ((broken, "overwrite"), (twice.coalesce(1), "overwrite"), (twice.repartition(4), "overwrite"), (spark.range(1).toDF("k"), "append")):
        with pytest.raises(Exception):  # noqa: B017  Spark's own
            sqlite.write(bad, path, "t", "CREATE TABLE t (k INTEGER PRIMARY KEY)", mode=mode)
        assert (tmp_path / "w.sqlite").read_bytes() == before and [p.name for p in tmp_path.iterdir()] == ["w.sqlite"]


def test_export_is_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "m.sqlite")
    editions = spark.createDataFrame([(1, "a", "a", 9, "r"), (2, "b", "b", 9, "r")], "edition_id int, edition_key string, rawi string, ayah_count int, reference string")
    mapping = spark.range(5000).select((F.col("id") % 2 + 1).cast("int").alias("edition_id"), (F.col("id") % 100).cast("int").alias("surah"), F.col("id").cast("int").alias("ayah"), F.lit(1).alias("hafs_ayah"))
    data = {"metadata": files.metadata_rows(spark, {"v": 1}), "editions": editions, "ayah_hafs_map": mapping}
    assert sqlite.export(path, data) == 5003 and sqlite.intact(path)
    before = (tmp_path / "m.sqlite").read_bytes()
    assert sqlite3.connect(path).execute("PRAGMA page_size").fetchone() == (sqlite.PAGE_SIZE,)
    with pytest.raises(ValueError, match="refers to no row"):
        sqlite.export(path, data | {"editions": editions.filter("edition_id = 1")})
    with pytest.raises(Exception):  # noqa: B017
        sqlite.export(path, data | {"ayah_hafs_map": mapping.union(mapping)})
    assert (tmp_path / "m.sqlite").read_bytes() == before and [p.name for p in tmp_path.iterdir()] == ["m.sqlite"]
    back = sqlite.read(spark, path, "ayah_hafs_map", partitions=6)
    assert rows(back) == rows(mapping)


def test_rows_pass_in_batches(spark, tmp_path, monkeypatch):
    """Batches go in and out; a range of the key holds a bounded number of rows, whatever number of tasks was asked for."""
    from pyspark.sql.types import StructType

    path = str(tmp_path / "b.sqlite")
    rows = [(k // 7, f"t{k % 7}", None if k % 5 == 0 else k / 4, k % 3 == 0) for k in range(1000)]
    df = spark.createDataFrame(rows, "a int, b string, c double, d boolean")
    ddl = "CREATE TABLE t (a INTEGER, b TEXT, c REAL, d INTEGER, PRIMARY KEY (a, b)) WITHOUT ROWID"
    sqlite.write(df, path, "t", ddl, ["a", "b"])
    assert isinstance(sqlite.SqliteSource({"path": path, "table": "t"}).writer(df.schema, True), sqlite.SqliteArrowWriter)
    monkeypatch.setattr(sqlite, "MOST_ROWS", 90)
    monkeypatch.setattr(sqlite, "BATCH", 40)
    reader = sqlite.SqliteReader({"path": path, "table": "t", "partitions": "3"}, StructType.fromDDL("a bigint, b string, c double, d bigint"))
    parts = reader.partitions()
    batches = [list(reader.read(p)) for p in parts]
    assert len(parts) == 12 and all(sum(b.num_rows for b in some) <= 90 and len(some) > 1 for some in batches)
    got = [tuple(r.values()) for some in batches for b in some for r in b.to_pylist()]
    assert got == sorted(((a, b, c, int(d)) for a, b, c, d in rows), key=lambda r: r[:2])
