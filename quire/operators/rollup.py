"""Page and chapter records from lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.spec import LayoutSpec


def line_struct() -> F.Column:
    return F.struct(F.col("line").cast("int").alias("line"), "first_word", "end_word")


def page_records(lines: DataFrame, page_chapters: DataFrame, spec: LayoutSpec) -> DataFrame:
    """One row for each page of the spine 1 .. the last page, empty ones too: its lines in order and its chapters."""
    own = lines.groupBy("edition_id", "page").agg(F.array_sort(F.collect_list(line_struct())).alias("lines"))
    ids = page_chapters.groupBy("edition_id", "page").agg(F.array_sort(F.collect_set("surah")).alias("surah_ids"))
    last = page_chapters.groupBy("edition_id").agg(F.max("page").alias("_last"))
    spine = last.select("edition_id", F.explode(F.sequence(F.lit(1), F.col("_last"))).alias("page"))
    whole = spine.join(own, ["edition_id", "page"], "left").join(ids, ["edition_id", "page"], "left")
    kind = lines.select(F.array(line_struct()).alias("l")).schema["l"].dataType
    return whole.select("edition_id", F.lit(spec.schema_version).alias("schema_version"), F.col("page").cast("int").alias("page"), F.coalesce("surah_ids", F.array().cast("array<int>")).alias("surah_ids"), F.lit(spec.font_family).cast("string").alias("font_family"), F.lit(spec.layout_source).alias("layout_source"), F.coalesce("lines", F.array().cast(kind)).alias("lines"))


def chapter_records(lines: DataFrame, chapters: DataFrame, spec: LayoutSpec, own_markers_only: bool = False) -> DataFrame:
    """One row for each chapter: its pages with its own lines, their range and totals, and its verses: the highest that
    an end of a line names (a word of another chapter does not count, nor, if asked for, a marker)."""
    top = lambda e: F.when((F.col(f"{e}.surah") == F.col("surah")) | (F.lit(not own_markers_only) & (F.col(f"{e}.type") == "ayah_marker")), F.coalesce(F.col(f"{e}.number"), F.col(f"{e}.ayah")))
    pages = lines.groupBy("edition_id", "surah", "page").agg(F.array_sort(F.collect_list(line_struct())).alias("lines"), F.max(F.greatest(F.coalesce(top("first_word"), F.lit(0)), F.coalesce(top("end_word"), F.lit(0)))).alias("_ayah"))
    kind = F.struct(F.col("page").cast("int").alias("page"), "lines")
    whole = pages.groupBy("edition_id", "surah").agg(
        F.min("page").cast("int").alias("startPage"), F.max("page").cast("int").alias("endPage"), F.count("*").cast("int").alias("totalPagesInSurah"),
        F.sum(F.size("lines")).cast("int").alias("totalCompletedLines"), F.max("_ayah").alias("ayaCount"), F.array_sort(F.collect_list(kind)).alias("pages"),
    )
    out = chapters.join(whole, ["edition_id", "surah"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("edition_id", F.lit(spec.schema_version).alias("schema_version"), F.col("surah").alias("surahId"), "surahName", "startPage", "endPage", zero("totalPagesInSurah"), zero("totalCompletedLines"), zero("ayaCount"), F.lit(spec.font_family).cast("string").alias("font_family"), F.lit(spec.layout_source).alias("layout_source"), F.coalesce("pages", F.array().cast(whole.schema["pages"].dataType)).alias("pages"))


def lines_of_pages(pages: DataFrame) -> DataFrame:
    """Page records as lines again."""
    return pages.select("edition_id", "page", F.explode("lines").alias("_l")).select("edition_id", "page", "_l.*")


def lines_of_chapters(surahs: DataFrame) -> DataFrame:
    return surahs.select("edition_id", F.col("surahId").alias("surah"), F.explode("pages").alias("_p")).select("edition_id", "surah", "_p.page", F.explode("_p.lines").alias("_l")).select("edition_id", "surah", "page", "_l.*")
