"""Constraints on layouts and mappings as queries for violations: (rule, key, detail), empty if all is well."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators.streams import previous
from quire.spec import ANCHORS, EDITIONS, LayoutSpec


class Violations(ValueError):
    """Raised at the edge of a build that must not go on."""


def violation(df: DataFrame, rule: str | Column, key: Column, detail: Column | str = "") -> DataFrame:
    rule = F.lit(rule) if isinstance(rule, str) else rule
    detail = F.lit(detail) if isinstance(detail, str) else detail
    return df.select(rule.alias("rule"), key.cast("string").alias("key"), F.coalesce(detail.cast("string"), F.lit("")).alias("detail"))


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def raise_if_any(violations: DataFrame) -> None:
    """Raises Violations with the first of them, in order of rule and key."""
    first = violations.orderBy("rule", "key", "detail").limit(1).collect()
    if first:
        raise Violations(f"{first[0].rule} at {first[0].key}: {first[0].detail}")


# sets

def difference(left: DataFrame, right: DataFrame, rule: str) -> DataFrame:
    """Rows of ``left`` that ``right`` lacks."""
    return violation(left.distinct().join(right.distinct(), left.columns, "left_anti"), rule, T.key(*left.columns))


def set_equality(have: DataFrame, want: DataFrame, name: str) -> DataFrame:
    """missing_<name> and extra_<name>."""
    return difference(want, have, f"missing_{name}").unionByName(difference(have, want, f"extra_{name}"))


def not_unique(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    return violation(df.groupBy(*keys).count().filter("count > 1"), f"duplicate_{name}", T.key(*keys), F.col("count"))


def foreign_key(df: DataFrame, parent: DataFrame, keys: list[str], name: str) -> DataFrame:
    return violation(df.select(*keys).distinct().join(parent.select(*keys).distinct(), keys, "left_anti"), f"orphan_{name}", T.key(*keys))


def spine(df: DataFrame, column: str, low: int, high: int, name: str) -> DataFrame:
    """Numbers low .. high that are missing, and others."""
    want = df.sparkSession.range(low, high + 1).select(F.col("id").cast("int").alias(column))
    return set_equality(df.select(F.col(column).cast("int").alias(column)).distinct(), want, name)


def required_tables(spark: SparkSession, names: list[str]) -> DataFrame:
    have = {t.name for t in spark.catalog.listTables()}
    return spark.createDataFrame([("missing_table", n, "") for n in sorted(set(names) - have)], "rule string, key string, detail string")


def required_columns(df: DataFrame, want: dict[str, str], name: str) -> DataFrame:
    """Columns that are missing or of another type."""
    have = dict(df.dtypes)
    rows = [("schema", f"{name}.{c}", f"{have.get(c)} instead of {t}") for c, t in want.items() if have.get(c) != t]
    return df.sparkSession.createDataFrame(rows, "rule string, key string, detail string")


# layouts

def manifest(df: DataFrame, spec: LayoutSpec) -> DataFrame:
    """schema_version, layout_source, total_pages and total_surahs of manifests."""
    want = {"schema_version": spec.schema_version, "layout_source": spec.layout_source, "total_pages": spec.pages, "total_surahs": spec.chapters}
    return union([violation(df.filter(~F.col(c).eqNullSafe(F.lit(v))), f"manifest_{c}", F.lit(c), F.col(c)) for c, v in want.items()])


def digests(files: DataFrame, want: DataFrame) -> DataFrame:
    """Files (name, sha256) whose digests differ from the wanted ones, or that are missing; a build refuses such a pair."""
    both = want.select("name", F.col("sha256").alias("_want")).join(files.select("name", F.col("sha256").alias("_have")), "name", "left")
    return violation(both.filter(~F.col("_have").eqNullSafe(F.col("_want"))), F.when(F.col("_have").isNull(), "missing_source").otherwise("digest"), F.col("name"), F.col("_have"))


def record_count(df: DataFrame, want: int, name: str) -> DataFrame:
    return violation(df.agg(F.count("*").alias("n")).filter(F.col("n") != want), f"{name}_count", F.lit(name), F.col("n"))


def page_lines(pages: DataFrame, spec: LayoutSpec) -> DataFrame:
    """Pages 1 .. the last, each of 1 .. max_lines lines, numbered without gaps."""
    n = F.size("lines")
    size = violation(pages.filter((n < 1) | (n > spec.max_lines)), "page_lines", T.key("edition_id", "page"), n)
    numbers = F.transform("lines", lambda x: x["line"])
    order = violation(pages.filter((n > 0) & (numbers != F.sequence(F.lit(1), n))), "line_numbers", T.key("edition_id", "page"), F.array_join(numbers.cast("array<string>"), ","))
    return size.unionByName(order).unionByName(spine(pages, "page", 1, spec.pages, "page"))


def line_keys(raw_lines: DataFrame, column: str = "json") -> DataFrame:
    """Lines as JSON whose keys are not exactly line, first_word and end_word."""
    keys = F.array_sort(F.json_object_keys(column))
    return violation(raw_lines.filter(~keys.eqNullSafe(F.array(F.lit("end_word"), F.lit("first_word"), F.lit("line")))), "line_keys", F.col(column))


def endpoint_positions(lines: DataFrame, words: DataFrame) -> DataFrame:
    """Adds to each end of a line (which: first, end) its verse's size, its word and its global position; a marker's
    position is that of its verse's last word."""
    ends = lines.select("edition_id", "page", "line", F.explode(F.array(F.struct(F.lit("first").alias("which"), F.col("first_word").alias("e")), F.struct(F.lit("end").alias("which"), F.col("end_word").alias("e")))).alias("_x")).select("edition_id", "page", "line", "_x.which", "_x.e")
    verses = words.groupBy("edition_id", "surah", "ayah").agg(F.max("wordIndex").alias("size"), F.max("pos").alias("last_pos"))
    keyed = ends.withColumn("surah", F.col("e.surah")).withColumn("ayah", F.col("e.ayah")).withColumn("wordIndex", F.col("e.wordIndex"))
    found = keyed.join(verses, ["edition_id", "surah", "ayah"], "left").join(words.select("edition_id", "surah", "ayah", "wordIndex", F.col("canonical").alias("own"), "pos"), ["edition_id", "surah", "ayah", "wordIndex"], "left")
    return found.withColumn("at", F.when(F.col("e.type") == "ayah_marker", F.col("last_pos")).otherwise(F.col("pos")))


def endpoints(lines: DataFrame, words: DataFrame) -> DataFrame:
    """Every end is a word or a marker with its fields; its verse exists and has words; a marker's number is its verse; a
    word's index is in range and its text is the verse's."""
    e, found = (lambda f: F.col(f"e.{f}")), endpoint_positions(lines, words)
    word, marker = e("type") == "word", e("type") == "ayah_marker"
    rule = (
        F.when(F.col("e").isNull(), "endpoint_missing")
        .when(e("type").isNull() | ~(word | marker), "endpoint_type")
        .when(e("surah").isNull() | e("ayah").isNull() | (word & (e("word").isNull() | e("wordIndex").isNull())) | (marker & e("number").isNull()), "endpoint_fields")
        .when(F.col("size").isNull(), "endpoint_verse")
        .when(marker & (e("number") != e("ayah")), "marker_number")
        .when(word & ((e("wordIndex") < 1) | (e("wordIndex") > F.col("size"))), "word_index")
        .when(word & (T.canonical(e("word")) != F.col("own")), "word_text")
    )
    return violation(found.withColumn("_rule", rule).filter("_rule is not null"), F.col("_rule"), T.key("edition_id", "page", "line", "which"), e("word"))


def continuity(lines: DataFrame, words: DataFrame) -> DataFrame:
    """Each line starts right after the one before, over pages too; it does not end before it starts; the first line
    starts with the first word and the last ends with the last."""
    at = endpoint_positions(lines, words).groupBy("edition_id", "page", "line").agg(F.max(F.when(F.col("which") == "first", F.col("at"))).alias("first"), F.max(F.when(F.col("which") == "end", F.col("at"))).alias("stop"))
    rows = previous(at, F.coalesce("stop", F.lit(-2).cast("long")), ["edition_id"], "page", ["line"], "_before").withColumn("_before", F.coalesce("_before", F.lit(-1)))
    place = T.key("edition_id", "page", "line")
    last = words.groupBy("edition_id").agg(F.max("pos").alias("_last"))
    ends = at.groupBy("edition_id").agg(F.max(F.struct("page", "line", "stop")).alias("_e")).select("edition_id", "_e.*").join(last, "edition_id")
    return union([
        violation(rows.filter(F.col("first") != F.col("_before") + 1), "continuity", place, F.concat_ws(">", "_before", "first")),
        violation(rows.filter("stop < first"), "line_backwards", place),
        violation(ends.filter("stop <> _last"), "last_word", place, F.col("stop")),
    ])


def present_continuity(lines: DataFrame, ayah_sizes: DataFrame | None = None) -> DataFrame:
    """Without the words: neighbouring lines (also of neighbouring pages) go on in the same verse at the next word, or
    with the first word of a later verse or chapter. For samples of a layout."""
    rows = previous(lines, F.struct("end_word", "page"), ["edition_id"], "page", ["line"], "_b").withColumn("_e", F.col("_b.end_word")).filter((F.col("page") - F.col("_b.page")) <= 1)
    s, e = "first_word", "_e"
    same = (F.col(f"{s}.surah") == F.col(f"{e}.surah")) & (F.col(f"{s}.ayah") == F.col(f"{e}.ayah"))
    next_word = same & (F.col(f"{e}.type") == "word") & (F.col(f"{s}.wordIndex") == F.col(f"{e}.wordIndex") + 1)
    next_verse = (F.col(f"{s}.wordIndex") == 1) & (((F.col(f"{s}.surah") == F.col(f"{e}.surah")) & (F.col(f"{s}.ayah") == F.col(f"{e}.ayah") + 1)) | ((F.col(f"{s}.surah") == F.col(f"{e}.surah") + 1) & (F.col(f"{s}.ayah") == 1)))
    return violation(rows.filter(~(next_word | next_verse)), "continuity", T.key("edition_id", "page", "line"))


def layout(pages: DataFrame, surahs: DataFrame, words: DataFrame, spec: LayoutSpec) -> DataFrame:
    """All rules of a layout's page and chapter records."""
    from quire.operators.rollup import lines_of_pages

    lines = lines_of_pages(pages)
    return union([page_lines(pages, spec), record_count(pages, spec.pages, "page"), record_count(surahs, spec.chapters, "chapter"), endpoints(lines, words), continuity(lines, words)])


# mappings

def mapping_complete(mapping: DataFrame, editions: DataFrame) -> DataFrame:
    """Every edition maps as many verses as it has."""
    n = mapping.groupBy("edition_id").agg(F.count_distinct("surah", "ayah").alias("n"))
    both = editions.select("edition_id", "ayah_count").join(n, "edition_id", "left")
    return violation(both.filter(~F.col("n").eqNullSafe(F.col("ayah_count"))), "mapped_verses", F.col("edition_id"), F.col("n"))


def mapping_monotone(mapping: DataFrame) -> DataFrame:
    """A verse's references have no gap, and do not start before those of the verse before end."""
    refs = mapping.groupBy("edition_id", "surah", "ayah").agg(F.min("hafs_ayah").alias("low"), F.max("hafs_ayah").alias("high"), F.count("*").alias("n"))
    back = F.lag("high").over(W.partitionBy("edition_id", "surah").orderBy("ayah"))
    gap = F.when(F.col("high") - F.col("low") + 1 != F.col("n"), F.struct(F.lit("reference_gap").alias("rule"), T.key("low", "high").alias("detail")))
    order = F.when(F.col("low") < F.col("_back"), F.struct(F.lit("reference_order").alias("rule"), T.key("_back", "low").alias("detail")))
    # both rules in one pass
    bad = refs.withColumn("_back", back).select("edition_id", "surah", "ayah", F.inline(F.filter(F.array(gap, order), lambda x: x.isNotNull())))
    return violation(bad, F.col("rule"), T.key("edition_id", "surah", "ayah"), F.col("detail"))


def mapping_coverage(mapping: DataFrame, counts: DataFrame, reference: int = 1) -> DataFrame:
    """In every chapter of every edition exactly the reference's verses are named; in chapter 1 other editions leave
    out the first. ``counts`` (surah, n) are the reference's."""
    of = mapping.select("edition_id").distinct()
    want = of.join(F.broadcast(counts.select("surah", "n")), F.lit(True)).select("edition_id", "surah", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("hafs_ayah"))  # a row for each chapter
    want = want.filter(~((F.col("surah") == 1) & (F.col("hafs_ayah") == 1) & (F.col("edition_id") != reference)))
    return set_equality(mapping.select("edition_id", "surah", "hafs_ayah").distinct(), want, "reference")


def mapping_identity(mapping: DataFrame, reference: int = 1) -> DataFrame:
    return violation(mapping.filter((F.col("edition_id") == reference) & (F.col("ayah") != F.col("hafs_ayah"))), "identity", T.key("edition_id", "surah", "ayah"), F.col("hafs_ayah"))


def mapping_anchors(mapping: DataFrame, anchors=ANCHORS) -> DataFrame:
    """Verses whose references are known."""
    want = mapping.sparkSession.createDataFrame([(e, s, a, list(r)) for e, s, a, r in anchors], "edition_id int, surah int, ayah int, want array<int>")
    have = mapping.groupBy("edition_id", "surah", "ayah").agg(F.array_sort(F.collect_set("hafs_ayah")).alias("have"))
    both = want.join(have, ["edition_id", "surah", "ayah"], "left")
    return violation(both.filter(~F.col("have").eqNullSafe(F.col("want"))), "anchor", T.key("edition_id", "surah", "ayah"), F.array_join(F.col("have").cast("array<string>"), ","))


def editions_equal(editions: DataFrame, want=EDITIONS) -> DataFrame:
    rows = editions.sparkSession.createDataFrame([(e.edition_id, e.edition_key, e.rawi, e.ayah_count, e.reference) for e in want], "edition_id int, edition_key string, rawi string, ayah_count int, reference string")
    return set_equality(editions.select(*rows.columns), rows, "edition")


def chapter_totals(ayat: DataFrame, spec: LayoutSpec, expected: dict[int, int]) -> DataFrame:
    """Chapters 1 .. n in every edition, and its verses in total."""
    counts = ayat.groupBy("edition_id", "surah").agg(F.count("*").alias("n"))
    want = ayat.sparkSession.createDataFrame(list(expected.items()), "edition_id int, want bigint")
    chapters = want.select("edition_id", F.explode(F.sequence(F.lit(1), F.lit(spec.chapters))).alias("surah"))
    total = want.join(counts.groupBy("edition_id").agg(F.sum("n").alias("n")), "edition_id", "left")
    return set_equality(counts.select("edition_id", "surah"), chapters, "chapter").unionByName(violation(total.filter(~F.col("n").eqNullSafe(F.col("want"))), "verse_total", F.col("edition_id"), F.col("n")))


def source_verses(ayat: DataFrame, spec: LayoutSpec) -> DataFrame:
    """Texts are there (unless the edition may lack them), pages are in range and every page has a verse."""
    place = T.key("edition_id", "surah", "ayah")
    parts = [violation(ayat.filter("text is null"), "null_text", place)] if not spec.null_text else []
    if spec.printed_marker:
        parts += [violation(ayat.filter(~F.coalesce(F.col("page").between(1, spec.pages), F.lit(False))), "page_range", place, F.col("page")), spine(ayat.filter(F.col("page").between(1, spec.pages)), "page", 1, spec.pages, "page")]
    return union(parts) if parts else violation(ayat.limit(0), "none", place)


def mapping(mapping_rows: DataFrame, editions: DataFrame, counts: DataFrame, reference: int = 1) -> DataFrame:
    """All rules of a mapping."""
    keys = ["edition_id", "surah", "ayah", "hafs_ayah"]
    return union([not_unique(mapping_rows, keys, "mapping"), foreign_key(mapping_rows, editions, ["edition_id"], "edition"), mapping_complete(mapping_rows, editions), mapping_monotone(mapping_rows), mapping_coverage(mapping_rows, counts, reference), mapping_identity(mapping_rows, reference)])
