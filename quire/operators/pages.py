"""Printed pages from formatted lines and tagged page segments.

Both hold the same text, the one with line breaks, the other with page breaks. A line belongs to the segment in whose
range of characters (white space and tags aside) it starts; equal texts confirm it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators.streams import assign_by_range, joined_text, ordinal, prefix_sum, prefix_sums, stream_part
from quire.spec import LayoutSpec

#: Lines and segments that are summed up together.
PART = 512


def same_line(text: Column) -> Column:
    """What lines of equal number go by, of their text as it comes."""
    return F.xxhash64(text)


def printed_pages(lines: DataFrame, segments: DataFrame, spec: LayoutSpec) -> tuple[DataFrame, DataFrame]:
    """(printed lines, violations): edition_id, page, line_in_page, text of ``lines`` (edition_id, line_no, text) placed
    on pages by ``segments`` (edition_id, segment_no, xml).

    Text before the first heading of the first segment does not count. A segment of more lines than a page holds is a
    missing page break: it is cut into full pages if its lines are a multiple of a page's, else it is a violation. A
    segment without text is an empty page, which shows as a gap in the page numbers.

    Places are found from the texts' lengths alone. Segments' lengths, runs of lines that share a part and a segment, and
    segments' pages are held in memory or on disk, as ``held`` of the printed lines, until the caller lets them go; no
    text is held. Printed lines' texts are dealt once, by part, where a few runs a part tell their pages.
    """
    key, parted = ["edition_id", "segment_no"], F.floor(F.col("segment_no") / PART).alias("_part")
    texts = lines.filter(T.has_text(F.col("text"))).withColumn("_same", same_line(F.col("text"))).withColumn("_part", F.floor(F.col("line_no") / PART))
    own = texts.withColumn("text", F.regexp_replace("text", rf"{T.SPACE}+$", "")).select("edition_id", "line_no", "text", "_same", "_part")
    whole = segments.select(*key, T.no_space(T.without_tags(F.col("xml"))).alias("_text"))
    spans = whole.select(*key, F.length("_text").alias("_size"), F.locate(T.HEADING, F.col("_text")).alias("_at")).persist()
    low = spans.groupBy("edition_id").agg(F.min("segment_no").alias("_lowest"))
    is_cut = (F.col("segment_no") == F.col("_lowest")) & (F.col("_at") > 0)
    segs = spans.join(low, "edition_id").select(*key, F.when(is_cut, F.col("_size") - F.col("_at") + 1).otherwise(F.col("_size")).alias("_size"), parted)
    ends = prefix_sum(segs, F.col("_size"), ["edition_id"], "_part", ["segment_no"], "_from").filter("_size > 0")
    ranges = ends.select(*key, "_from", (F.col("_from") + F.col("_size") - 1).alias("_to"))
    sizes = own.select("edition_id", "line_no", "_same", "_part", F.length(T.no_space(F.col("text"))).alias("_size"))
    spots = prefix_sums(sizes, {"at": F.col("_size"), "_row": F.lit(1)}, ["edition_id"], "_part", ["line_no", "_same"])
    found = assign_by_range(spots.select("edition_id", "_part", "_row", "at"), ranges, ["edition_id"], "at", ("_from", "_to"), ["segment_no", "_from"])
    runs = found.groupBy("edition_id", "_part", "segment_no", "_from").agg(F.count("*").alias("n"), F.min("_row").alias("_first"))
    # lines behind all segments are the last one's
    last = ranges.groupBy("edition_id").agg(F.max_by("segment_no", "_from").alias("_last"))
    runs = runs.join(last, "edition_id", "left").withColumn("segment_no", F.when(F.col("_from").isNull(), F.col("_last")).otherwise(F.col("segment_no"))).drop("_from", "_last").persist()

    counts = runs.groupBy(key).agg(F.sum("n").alias("n"), F.min("_first").alias("_start"))
    sized = segs.select(*key, "_part").join(counts, key, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rows = sized.withColumn("_pages", F.when(F.col("n") > spec.max_lines, F.ceil(F.col("n") / spec.max_lines)).otherwise(1))
    paged = prefix_sum(rows, F.col("_pages"), ["edition_id"], "_part", ["segment_no"], "_before").select(*key, "n", "_start", "_before").persist()
    run = F.struct("_first", "_start", "_before", "segment_no")
    marks = runs.join(paged.drop("n"), key, "left").groupBy(stream_part(["edition_id"], "_part")).agg(F.array_sort(F.collect_list(run)).alias("_runs"))

    dealt = own.select(stream_part(["edition_id"], "_part"), "line_no", "_same", "text")
    placed = ordinal(dealt, ["_stream"], ["line_no", "_same"], "_row").join(marks, "_stream")
    placed = placed.withColumn("_row", F.element_at("_runs", 1)["_first"] + F.col("_row") - 1)
    placed = placed.withColumn("_run", F.element_at(F.filter("_runs", lambda x: x["_first"] <= F.col("_row")), -1))
    placed = placed.select(F.col("_stream._key0").alias("edition_id"), "line_no", "text", "_row", "_run.segment_no", "_run._start", "_run._before")

    nth = F.col("_row") - F.col("_start")
    page, line = F.col("_before") + F.floor(nth / spec.max_lines) + 1, nth % spec.max_lines + 1
    out = placed.filter("_before is not null").select("edition_id", page.cast("int").alias("page"), line.cast("int").alias("line_in_page"), "text")

    lines_of = F.concat(F.lit("lines: "), F.col("n")).alias("detail")
    joined = placed.filter("segment_no is not null").withColumn("_plain", T.no_space(F.col("text"))).groupBy(key).agg(joined_text("_plain", "_row").alias("own"), F.count("*").alias("n"))
    cut_at = low.join(spans.filter("_at > 0"), "edition_id").filter("segment_no = _lowest").select(*key, "_at").distinct()
    spelt = whole.filter("edition_id is not null").join(cut_at, key, "left").select(*key, F.expr("substring(_text, coalesce(_at, 1))").alias("target")).join(joined, key, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    wrong = F.coalesce(F.col("own"), F.lit("")) != F.col("target")
    odd = (F.col("n") > spec.max_lines) & (F.col("n") % spec.max_lines != 0)
    bad = spelt.filter(wrong).select(F.lit("text_page_mismatch").alias("rule"), T.key(*key).alias("key"), lines_of)
    bad = bad.unionByName(paged.filter(odd).select(F.lit("page_segment_size").alias("rule"), T.key(*key).alias("key"), lines_of))
    lost = placed.filter("segment_no is null").select(F.lit("unconsumed_line").alias("rule"), T.key("edition_id", "line_no").alias("key"), F.col("text").alias("detail"))
    out.held = (spans, runs, paged)
    return out, bad.unionByName(lost)


def page_counts(segments: DataFrame, lines: DataFrame, spec: LayoutSpec, printed: DataFrame) -> DataFrame:
    """What a manifest says of its source: page tags, segments, repaired breaks, lines."""
    segs = segments.groupBy("edition_id").agg((F.count("*") - 1).alias("raw_beginpage_count"), F.count("*").alias("raw_page_segments"))
    text = lines.filter(T.has_text(F.col("text"))).groupBy("edition_id").agg(F.count("*").alias("formatted_nonempty_lines"))
    pages = printed.groupBy("edition_id").agg(F.max("page").alias("pages"))
    return segs.join(text, "edition_id", "left").join(pages, "edition_id", "left").withColumn("split_missing_page_breaks", F.greatest(F.lit(0), F.col("pages") - F.col("raw_page_segments")))
