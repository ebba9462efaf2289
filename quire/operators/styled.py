"""Layout of a styled document from its inline events.

Everything that a reader of the events would carry along is a running count: chapters (headings so far), pages (rendered
breaks so far), lines (breaks so far in the paragraph), verses and words (the last marker so far).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators.align_exact import marker_endpoint, word_endpoint
from quire.operators.streams import first_known, joined_text, ordinal, prefix_sum, running
from quire.operators.words import explode_parts, inline_numbering

#: Paragraphs whose breaks and headings are summed up together.
PART = 256


def merged_runs(runs: Column) -> Column:
    """Joins the text of neighbouring runs (struct<text, style>) of equal style, in an array's order.

    A run joins the one before if that has the same values in all fields that the run has (flags that it lacks do not
    count); what is joined keeps the first's style.
    """
    def same(a: Column, b: Column) -> Column:
        always = [a[f].eqNullSafe(b[f]) for f in ("font_family", "font_size_half_points", "rtl")]
        flags = [b[f].isNull() | a[f].eqNullSafe(b[f]) for f in ("bold", "italic", "hidden")]
        return reduce(Column.__and__, [*always, *flags])

    def add(done: Column, run: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(F.concat(last["text"], run["text"]).alias("text"), last["style"].alias("style"))
        return F.when(F.size(done) == 0, F.array(run)).when(same(last["style"], run["style"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(run)))

    kind = "array<struct<text:string,style:struct<font_family:string,font_size_half_points:int,rtl:boolean,bold:boolean,italic:boolean,hidden:boolean>>>"
    return F.aggregate(runs, F.array().cast(kind), add)


def kinds(events: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """doc, para_no, props, text, kind (heading, blank, opening, text) and surah, headings so far."""
    texts = events.filter("type = 'text'").groupBy("doc", "para_no").agg(joined_text("value", "event_no").alias("raw"))
    rows = paragraphs.join(texts, ["doc", "para_no"], "left").withColumn("text", T.strip_meta(F.col("raw"))).drop("raw")
    kind = F.when(T.is_styled_heading(F.col("text")), "heading").when(T.strip(F.col("text")) == "", "blank").when(T.starts_with_opening(F.col("text")), "opening").otherwise("text")
    rows = rows.withColumn("kind", kind).withColumn("_part", F.floor(F.col("para_no") / PART))
    rows = prefix_sum(rows, (F.col("kind") == "heading").cast("int"), ["doc"], "_part", ["para_no"], "surah", before=False)
    return rows.withColumn("surah", F.col("surah").cast("int")).drop("_part")


def paged_events(events: DataFrame, kinds_of: DataFrame) -> DataFrame:
    """Adds kind, surah, props, page (1 and the rendered breaks before the event; those of text before the first heading
    do not count) and piece (line and rendered breaks before it in the paragraph). Explicit page breaks are ignored."""
    rows = events.join(kinds_of.select("doc", "para_no", "kind", "surah", "props"), ["doc", "para_no"]).withColumn("_part", F.floor(F.col("para_no") / PART))
    counts = (F.col("type") == "rendered_page_break") & ~((F.col("kind") == "text") & (F.col("surah") == 0))
    rows = prefix_sum(rows, counts.cast("int"), ["doc"], "_part", ["para_no", "event_no"], "_pages")
    ends = F.col("type").isin("line_break", "rendered_page_break")
    return rows.withColumn("page", (F.col("_pages") + 1).cast("int")).withColumn("piece", running(ends.cast("int"), ["doc", "para_no"], ["event_no"], before=True)).drop("_part", "_pages")


def styled_lines(paged: DataFrame) -> DataFrame:
    """doc, page, line, surah, para_no, piece, text, props, runs of the printed lines in text paragraphs."""
    text = paged.filter("type = 'text' and kind = 'text' and surah > 0").withColumn("_chunk", T.clean_chunk(F.col("value"))).filter("_chunk <> ''")
    runs = F.transform(F.array_sort(F.collect_list(F.struct("event_no", F.col("_chunk").alias("text"), "style"))), lambda x: F.struct(x["text"].alias("text"), x["style"].alias("style")))
    pieces = text.groupBy("doc", "para_no", "piece", "surah").agg(F.min("page").alias("page"), F.first("props").alias("props"), runs.alias("runs"))
    pieces = pieces.withColumn("text", T.strip_meta(F.array_join(F.transform("runs", lambda r: r["text"]), ""))).filter(T.strip(F.col("text")) != "")
    return ordinal(pieces, ["doc", "page"], ["para_no", "piece"], "line").withColumn("runs", merged_runs(F.col("runs")))


def ends_of_lines(lines: DataFrame) -> DataFrame:
    """Adds first_word, end_word and verses_on_line; verses and words are numbered by the markers in the text. Lines
    without a word or marker go, but keep their number."""
    place = ["page", "line"]
    parts = explode_parts(lines.select("doc", "surah", *place, "text"), "text", leading=False)
    order = [*place, "raw_pos", "sub_pos"]
    # a chapter is a group
    rows = inline_numbering(parts, ["doc", "surah"], order).withColumn("w", F.struct("surah", "ayah", F.col("token").alias("word"), "wordIndex"))
    end = F.when(F.col("marker").isNotNull(), marker_endpoint(F.col("surah"), F.col("ayah"))).otherwise(word_endpoint("w"))
    at = F.struct("raw_pos", "sub_pos")
    verses = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.col("marker").isNull(), F.struct("raw_pos", "sub_pos", T.key("surah", "ayah").alias("v"))))), lambda x: x["v"]))
    per_line = rows.withColumn("e", end).groupBy("doc", *place).agg(F.min_by("e", at).alias("first_word"), F.max_by("e", at).alias("end_word"), verses.alias("verses_on_line"))
    return lines.join(per_line, ["doc", *place])


def structural(paged: DataFrame, kinds_of: DataFrame) -> DataFrame:
    """Headings and opening formulas with the page after their breaks, and the first size of an opening's runs."""
    pages = paged.groupBy("doc", "para_no").agg(F.max(F.col("page") + (F.col("type") == "rendered_page_break").cast("int")).alias("page"))
    sized = paged.filter("type = 'text'").withColumn("_size", first_known("style.font_size_half_points", ["doc", "para_no"], ["event_no"])).groupBy("doc", "para_no").agg(F.first("_size").alias("font_size_half_points"))
    rows = kinds_of.filter("kind in ('heading', 'opening')").join(pages, ["doc", "para_no"], "left").join(sized, ["doc", "para_no"], "left")
    return rows.select("doc", "para_no", "page", "surah", "kind", T.strip(F.col("text")).alias("text"), "props", "font_size_half_points", F.when(F.col("kind") == "heading", T.styled_heading_name(F.col("text"))).alias("surahName"))


def layout(events: DataFrame, paragraphs: DataFrame) -> dict[str, DataFrame]:
    """lines (with ends), elements (headings and formulas), page_chapters and chapters of styled documents."""
    kind = kinds(events, paragraphs)
    paged = paged_events(events, kind)
    lines = ends_of_lines(styled_lines(paged))
    elements = structural(paged, kind)
    heads = elements.filter("kind = 'heading'").select("doc", "page", "surah")
    return {"lines": lines, "elements": elements, "page_chapters": heads.union(lines.select("doc", "page", "surah")).distinct(), "chapters": elements.filter("kind = 'heading'").select("doc", "surah", "surahName")}
