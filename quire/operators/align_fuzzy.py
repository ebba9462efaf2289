"""Fuzzy alignment of a page's segments with the page's words.

Segments and words are ordered, so an alignment cuts the page's words into one run for each segment. A run's cost is the
edit distance between the segment and the joined words, within a limit that grows with the segment; the cuts of the
least total cost win, and of equal ones those whose starts were reached first. A run stays in the segment's chapter,
and its last word in the verse of the segment's marker, if it has one.

One pass over a page's words gives the distances from all starts of a segment to all its ends.

Pages are independent: a row each, with its segments and words as arrays, bounded by a page.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators.align_exact import marker_endpoint, word_endpoint
from quire.operators.words import page_positions
from quire.spec import LayoutSpec

PATH = "edition_id int, page int, line int, seg int, surah int, marker int, start bigint, stop bigint, distance int, status string, detail string"


def limit_of(length: int, spec: LayoutSpec) -> int:
    return max(2, min(spec.max_distance, max(2, int(length * spec.distance_ratio))))


def distances(target: str, words: list[dict], starts: list[int], surah: int, limit: int, most: int) -> dict[int, list[tuple[int, int]]]:
    """start -> [(end, distance)]: the runs of at most ``most`` words of the chapter within the ``limit``, for all starts in
    one pass over the characters.

    A row of a distance table holds the distances of what was read to all heads of the target. Neighbours in it differ by one
    at most, so it is two numbers, whose bits say where it rises and where it falls. Every start has such bits of its own
    in a lane of the same two numbers, and a guard bit above them keeps a sum's carry in its lane.
    """
    size, width = len(target), len(target) + 1
    heads: dict[str, int] = {}
    for k, c in enumerate(target):
        heads[c] = heads.get(c, 0) | 1 << k
    lanes = {start: k * width for k, start in enumerate(sorted(starts))}
    all_ones = sum(1 << at for at in lanes.values())
    # each character's places, in every lane
    places = {c: bits * all_ones for c, bits in heads.items()}
    whole, place = (1 << size) - 1, places.get
    out: dict[int, list[tuple[int, int]]] = {start: [] for start in starts}
    running: dict[int, int] = {}  # start: characters read before
    every = ones = rises = falls = read = 0
    for k in range(min(lanes), len(words)):
        if k in lanes:
            at = lanes[k]
            running[k], every, ones, rises = read, every | whole << at, ones | 1 << at, rises | whole << at
        if not running:
            if k >= max(lanes):
                break
            read += len(words[k]["f"])
            continue
        if words[k]["surah"] != surah:
            running, every, ones, rises, falls = {}, 0, 0, 0, 0
            continue
        for c in words[k]["f"]:
            # where a distance equals the one before it in both texts
            same = place(c, 0) & every | falls
            same |= (rises & same) + rises ^ rises
            # where a distance is above or below that of the row before
            up, down = (falls | (rises | same) & every ^ every) << 1 | ones, (rises & same) << 1
            rises, falls = down & every | (up | same) & every ^ every, every & up & same
        read += len(words[k]["f"])
        # starts come in order: if the first has read too little, all have
        start = next(iter(running))
        if read - running[start] < size - limit and k + 1 - start < most:
            continue
        for start, before in list(running.items()):
            at, n = lanes[start], read - before
            if abs(n - size) <= limit:
                distance = n + (rises >> at & whole).bit_count() - (falls >> at & whole).bit_count()
                if distance <= limit:
                    out[start].append((k + 1, distance))
            # longer runs differ in length alone by more than the limit
            if n > size + limit or k + 1 - start >= most:
                del running[start]
                left = ~(whole << at)
                every, ones, rises, falls = every & left, ones & ~(1 << at), rises & left, falls & left
    return out


def reach(segment: dict, starts: dict[int, int], words: list[dict], spec: LayoutSpec) -> dict[int, tuple[int, int, int]]:
    """end -> (cost, start, distance) for all ends that a segment can have, in the order that they are reached."""
    found: dict[int, tuple[int, int, int]] = {}
    near = distances(segment["f"], words, list(starts), segment["surah"], limit_of(len(segment["f"]), spec), spec.max_words)
    for start, cost in starts.items():
        for end, distance in near[start]:
            marked = segment["marker"] is None or words[end - 1]["ayah"] == segment["marker"]
            if marked and (end not in found or cost + distance < found[end][0]):
                found[end] = (cost + distance, start, distance)
    return found


def align_words(segments: list[dict], words: list[dict], spec: LayoutSpec) -> tuple[list[tuple[int, int, int]], str, str]:
    """((start, stop, distance) of each segment, status, detail); status is ok, no_state or wrong_end."""
    starts, layers = {0: 0}, []
    for segment in segments:
        layer = reach(segment, starts, words, spec)
        if not layer:
            return [], "no_state", f"line {segment['line']}: {segment['text']}"
        layers.append(layer)
        starts = {end: state[0] for end, state in layer.items()}
    if len(words) not in starts:
        best = sorted((cost, end) for end, cost in starts.items())[:5]
        return [], "wrong_end", f"words {len(words)}, best {best}"
    path, end = [], len(words)
    for layer in reversed(layers):
        _, start, distance = layer[end]
        path.append((start, end, distance))
        end = start
    return path[::-1], "ok", ""


def records(column: pa.ListArray) -> Iterator[list[dict]]:
    """Each row's structs; null is none. Their fields are taken out as whole columns, not struct by struct."""
    inner = column.flatten()
    fields = [inner.field(k).to_pylist() for k in range(inner.type.num_fields)]
    names, at = [f.name for f in inner.type], 0
    for n in pc.list_value_length(column).to_pylist():
        yield [dict(zip(names, values, strict=True)) for values in zip(*(f[at : at + (n or 0)] for f in fields), strict=True)]
        at += n or 0


def align_pages(segs: DataFrame, stream: DataFrame, spec: LayoutSpec) -> DataFrame:
    """A row for each segment with the words start .. stop - 1 of its page; pages that fail have one row that says why."""
    names = [c.split()[0] for c in PATH.split(", ")]
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in PATH.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            editions, pages = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for edition, page, segments, words in zip(editions, pages, records(batch.column(2)), records(batch.column(3)), strict=True):
                path, status, detail = align_words(segments, words, spec)
                if status != "ok":
                    rows.append((edition, page, None, None, None, None, None, None, None, status, detail))
                else:
                    rows += [(edition, page, s["line"], s["seg"], s["surah"], s["marker"], *at, status, detail) for s, at in zip(segments, path, strict=True)]
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def by_page(rows: DataFrame, name: str, *columns: str) -> DataFrame:
        return rows.groupBy("edition_id", "page").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))  # a page's rows

    left = by_page(segs.withColumn("f", T.fuzzy_canonical(F.col("text"))), "segments", "line", "seg", "surah", "text", "f", "marker")
    right = by_page(page_positions(stream), "words", "page_pos", "surah", "ayah", "f")
    return left.join(right, ["edition_id", "page"], "full").select("edition_id", "page", "segments", "words").mapInArrow(run, PATH)


def align(segs: DataFrame, ends: DataFrame, stream: DataFrame, spec: LayoutSpec) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lines, violations, path): as exact alignment; a line that ends with a marker keeps the printed number."""
    path = align_pages(segs.filter("text <> ''"), stream, spec).persist()
    good = path.filter("status = 'ok'")
    keys = ["edition_id", "page", "line"]
    spans = good.groupBy(*keys, "surah").agg(F.min_by("start", "seg").alias("_from"), (F.max_by("stop", "seg") - 1).alias("_to"), F.max_by(F.struct("marker"), "seg").alias("_end"))
    placed = page_positions(stream).select("edition_id", "page", "page_pos", F.struct("surah", "ayah", "word", "wordIndex").alias("w"))
    first = placed.select("edition_id", "page", F.col("page_pos").alias("_from"), F.col("w").alias("first"))
    last = placed.select("edition_id", "page", F.col("page_pos").alias("_to"), F.col("w").alias("last"))
    both = spans.join(first, ["edition_id", "page", "_from"]).join(last, ["edition_id", "page", "_to"])
    end = F.when(F.col("_end.marker").isNotNull(), marker_endpoint(F.col("surah"), F.col("_end.marker"))).otherwise(word_endpoint("last"))
    lines = both.select(*keys, "surah", word_endpoint("first").alias("first_word"), end.alias("end_word"))
    bad = path.filter("status <> 'ok'").select(F.col("status").alias("rule"), T.key("edition_id", "page").alias("key"), "detail")
    lone = segs.filter("text = '' and marker is not null").select(F.lit("marker_without_text").alias("rule"), T.key("edition_id", "page", "line").alias("key"), F.col("marker").cast("string").alias("detail"))
    return lines, bad.unionByName(lone), path


def path_totals(path: DataFrame) -> DataFrame:
    """Segments with a distance, and the sum of all distances, by edition."""
    return path.groupBy("edition_id").agg(F.count_if(F.col("distance") > 0).alias("fuzzy_segments"), F.coalesce(F.sum("distance"), F.lit(0)).alias("total_edit_distance"))
