"""Exact alignment of printed segments with the word stream.

Printed white space is no reliable word boundary, so both sides are one stream of characters without it (in the loose
normal form). A segment owns the words that start in its range of characters; words without characters of their own
go to the segment after. The alignment holds if every segment's words spell it and no word is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators.streams import assign_by_range, joined_text, prefix_sum, prefix_sums
from quire.spec import LayoutSpec


def word_endpoint(w: str) -> Column:
    """An endpoint of a word struct column."""
    return F.struct(F.lit("word").alias("type"), F.col(f"{w}.surah").alias("surah"), F.col(f"{w}.ayah").alias("ayah"), F.col(f"{w}.word").alias("word"), F.col(f"{w}.wordIndex").cast("int").alias("wordIndex"), F.lit(None).cast("int").alias("number"))


def marker_endpoint(surah: Column, ayah: Column) -> Column:
    return F.struct(F.lit("ayah_marker").alias("type"), surah.alias("surah"), ayah.alias("ayah"), F.lit(None).cast("string").alias("word"), F.lit(None).cast("int").alias("wordIndex"), ayah.alias("number"))


def matched_words(segs: DataFrame, stream: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(words, segments): every word of ``stream`` (with its offset ``at``, or that is found here) with the (page, line, seg, seg_surah) that owns it, nulls if none;
    segments with text, with their ranges at .. at + size."""
    seg = segs.withColumn("_loose", T.canonical_loose(F.col("text"))).withColumn("size", F.length("_loose"))
    seg = prefix_sums(seg, {"at": F.col("size")}, ["edition_id"], "page", ["line", "seg"])
    own = stream.drop("page") if "at" in stream.columns else prefix_sum(stream.drop("page"), F.length("loose"), ["edition_id"], "surah", ["ayah", "wordIndex"], "at")
    starts = seg.filter("size > 0").select("edition_id", "at", (F.col("at") + F.col("size") - 1).alias("last"), "page", "line", "seg", F.col("surah").alias("seg_surah"))
    found = assign_by_range(own, starts, ["edition_id"], "at", ("at", "last"), ["page", "line", "seg", "seg_surah"])
    out = found.select("edition_id", "surah", "ayah", "wordIndex", "word", "pos", "loose", "page", "line", "seg", "seg_surah")
    return out, seg


def align(segs: DataFrame, ends: DataFrame, stream: DataFrame, spec: LayoutSpec) -> tuple[DataFrame, DataFrame]:
    """(lines, violations): edition_id, page, line, surah, first_word, end_word of each text line.

    A line ends with a marker if its last part is one; the marker's verse is that of the line's last word, not the
    printed number, which may have drifted.
    """
    found, seg = matched_words(segs, stream)
    owned = found.filter("page is not null")
    word = F.struct("surah", "ayah", "word", "wordIndex")
    per_line = owned.groupBy("edition_id", "page", "line").agg(F.min_by(word, "pos").alias("first"), F.max_by(word, "pos").alias("last"))
    whole = ends.join(per_line, ["edition_id", "page", "line"], "left")
    end = F.when(F.col("ends_with_marker"), marker_endpoint(F.col("surah"), F.col("last.ayah"))).otherwise(word_endpoint("last"))
    lines = whole.filter("first is not null").select("edition_id", "page", "line", "surah", word_endpoint("first").alias("first_word"), end.alias("end_word"))

    place = T.key("edition_id", "page", "line")
    spelt = owned.groupBy("edition_id", "page", "line", "seg").agg(joined_text("loose", "pos").alias("_own"))
    compared = seg.join(spelt, ["edition_id", "page", "line", "seg"], "left")
    rule = lambda df, name, key, detail: df.select(F.lit(name).alias("rule"), key.alias("key"), detail.alias("detail"))
    bad = rule(compared.filter((F.col("size") > 0) & (F.coalesce(F.col("_own"), F.lit("")) != F.col("_loose"))), "segment_mismatch", place, F.col("text"))
    hidden = (F.col("size") == 0) & (T.canonical(F.col("text")) != "")
    bad = bad.unionByName(rule(seg.filter(hidden), "segment_of_hamza_only", place, F.col("text")))
    bad = bad.unionByName(rule(owned.filter("surah <> seg_surah"), "chapter_mismatch", place, T.key("surah", "ayah", "wordIndex")))
    bad = bad.unionByName(rule(found.filter("page is null"), "unconsumed_word", T.key("edition_id", "surah", "ayah", "wordIndex"), F.col("word")))
    return lines, bad.unionByName(rule(whole.filter("first is null"), "line_without_words", place, F.lit("")))
