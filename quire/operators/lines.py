"""Printed lines: their kinds, chapters and numbers, and the segments between verse markers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators.streams import cut, ordinal, prefix_sum
from quire.spec import LayoutSpec


def classified(printed: DataFrame, spec: LayoutSpec) -> DataFrame:
    """Adds kind (heading, opening, text) and surah (headings so far) to printed lines; blank lines go.

    The opening formula alone on a line is structural, from the chapter on that the edition says.
    """
    text = T.strip(F.col("text"))
    rows = printed.filter(text != "").withColumn("text", text).withColumn("_heading", T.is_heading(text))
    rows = prefix_sum(rows, F.col("_heading").cast("int"), ["edition_id"], "page", ["line_in_page"], "surah", before=False)
    structural = T.is_opening(F.col("text")) & (F.col("surah") >= spec.opening_from)
    kind = F.when(F.col("_heading"), "heading").when(structural, "opening").otherwise("text")
    return rows.withColumn("kind", kind).withColumn("surah", F.col("surah").cast("int")).drop("_heading")


def numbered(lines: DataFrame) -> DataFrame:
    """Text lines with their numbers on the page; headings and formulas are not counted."""
    return ordinal(lines.filter("kind = 'text'"), ["edition_id", "page"], ["line_in_page"], "line")


def chapters(lines: DataFrame) -> DataFrame:
    """edition_id, surah, surahName from the headings."""
    return lines.filter("kind = 'heading'").select("edition_id", "surah", T.heading_name(F.col("text")).alias("surahName"))


def page_chapters(lines: DataFrame) -> DataFrame:
    """(edition_id, page, surah) of all kinds of lines."""
    return lines.filter("surah > 0").select("edition_id", "page", "surah").distinct()


def segments(text_lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(segments, ends): the texts between markers, a line's rest too, as edition_id, page, line, seg, surah, text, marker;
    and for each line whether its last part is a marker (edition_id, page, line, surah, ends_with_marker, marker)."""
    split = text_lines.select("edition_id", "page", "line", "surah", T.split_line(F.col("text")).alias("_parts"))
    # a segment ends with a marker or the line; cuts are the numbers of parts before the ends
    marked = F.filter(F.sequence(F.lit(1), F.size("_parts")), lambda i: F.element_at("_parts", i)["marker"].isNotNull())
    cuts = split.select("*", F.explode(F.when(F.size("_parts") > 0, F.array(F.array_distinct(F.concat(F.array(F.lit(0)), marked, F.array(F.size("_parts"))))))).alias("_cuts"))
    own = F.transform(F.sequence(F.lit(1), F.size("_cuts") - 1), lambda k: cut("_parts", F.element_at("_cuts", k) + 1, F.element_at("_cuts", k + 1)))
    each = cuts.select("edition_id", "page", "line", "surah", F.posexplode(own).alias("seg", "_own"))
    segs = each.select("edition_id", "page", "line", "surah", "seg", F.array_join(F.transform("_own", lambda p: p["token"]), "").alias("text"), F.element_at("_own", -1)["marker"].alias("marker"))
    last = split.select("edition_id", "page", "line", "surah", F.explode(F.slice("_parts", -1, 1)).alias("_last"))
    ends = last.select("edition_id", "page", "line", "surah", F.col("_last.marker").alias("marker"), F.col("_last.marker").isNotNull().alias("ends_with_marker"))
    return segs, ends


def line_violations(lines: DataFrame, spec: LayoutSpec) -> DataFrame:
    """Text before the first heading; more headings than chapters, or fewer."""
    early = lines.filter("kind = 'text' and surah = 0").select(F.lit("text_before_heading").alias("rule"), T.key("edition_id", "page", "line_in_page").alias("key"), F.col("text").alias("detail"))
    counts = lines.groupBy("edition_id").agg(F.max("surah").alias("n")).filter(F.col("n") != spec.chapters)
    wrong = counts.select(F.lit("chapter_count").alias("rule"), F.col("edition_id").cast("string").alias("key"), F.concat(F.lit("headings: "), F.col("n")).alias("detail"))
    return early.unionByName(wrong)
