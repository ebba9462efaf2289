"""Mapping of verses between editions.

The texts of a chapter's verses, in a normal form, are one string in each edition. The edit script from an edition's
string to the reference's carries the ends of every verse over; a verse corresponds to the reference verses that its
carried span overlaps.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.functions.edits import opcodes
from quire.operators.streams import assign_by_range, joined_text, overlap_join, running


def verse_spans(ayat: DataFrame, normal: Column | None = None) -> DataFrame:
    """edition_id, surah, ayah, norm, start, stop: each verse's place in its chapter's string."""
    rows = ayat.select("edition_id", "surah", "ayah", (T.mapping_normal(F.col("text")) if normal is None else normal).alias("norm"))
    stop = running(F.length("norm"), ["edition_id", "surah"], ["ayah"])
    return rows.withColumn("stop", stop.cast("long")).withColumn("start", F.col("stop") - F.length("norm"))


def chapter_opcodes(source: DataFrame, target: DataFrame) -> DataFrame:
    """edition_id, surah, block, tag, src_start, src_end, dest_start, dest_end: the blocks of the edit script from each
    edition's chapter to the reference's. A row for each chapter goes in, so that editions and chapters are independent tasks."""
    schema = pa.schema([("edition_id", pa.int32()), ("surah", pa.int32()), ("block", pa.int32()), ("tag", pa.string()), *((n, pa.int64()) for n in ("src_start", "src_end", "dest_start", "dest_end"))])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []  # of many chapters, as most have few
        for given in batches:
            for edition, surah, a, b in zip(*given.columns, strict=True):
                key = edition.as_py(), surah.as_py()
                rows += [(*key, k, *op) for k, op in enumerate(opcodes(a.as_py(), b.as_py()))]
                if len(rows) > 5000:
                    yield batch(rows)
                    rows = []
        if rows:
            yield batch(rows)

    whole = lambda df, *keys: df.groupBy(*keys).agg(joined_text("norm", "ayah").alias("text"))
    both = whole(source, "edition_id", "surah").join(whole(target, "surah").withColumnRenamed("text", "other"), "surah", "left")
    # rows are few and their work is not: they are dealt out whatever their size, by a hash that no exchange before has, as the
    # two would become one, of tasks merged by their bytes
    tasks = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = both.select("edition_id", "surah", "text", F.coalesce("other", F.lit("")).alias("other")).repartition(tasks, F.xxhash64("edition_id", "surah"))
    return rows.mapInArrow(run, "edition_id int, surah int, block int, tag string, src_start bigint, src_end bigint, dest_start bigint, dest_end bigint")


def block_ranges(blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``at``: the first boundary that each carries. A boundary belongs to the first block whose closed range
    holds it, so that a block begins after its predecessor's end, and an insertion carries none but at the very start."""
    before = F.lag("src_end").over(W.partitionBy("edition_id", "surah").orderBy("block"))
    return blocks.withColumn("at", F.coalesce(before + 1, F.lit(0))).filter("at <= src_end")


def carried(pos: Column, end: Column) -> Column:
    """A boundary carried over by the block that holds it; with ``end``, past what is inserted there."""
    within = (pos - F.col("src_start")) / T.at_least_one(F.col("src_end") - F.col("src_start"))
    replaced = F.col("dest_start") + T.half_even(within * (F.col("dest_end") - F.col("dest_start"))).cast("long")
    inserted = F.when(end, F.col("dest_end")).otherwise(F.col("dest_start"))
    return F.when(F.col("tag") == "equal", F.col("dest_start") + pos - F.col("src_start")).when(F.col("tag") == "replace", replaced).when(F.col("tag") == "delete", F.col("dest_start")).otherwise(inserted)


def mapped_spans(source: DataFrame, target: DataFrame) -> DataFrame:
    """edition_id, surah, ayah, start, stop of ``source`` with dest_start and dest_stop in the reference's string.

    Boundaries and blocks meet in bins of the chapter's offsets, and scripts are made once: no verse carries its chapter's.
    Two empty chapters have no blocks; their boundaries are carried to 0."""
    blocks = block_ranges(chapter_opcodes(source, target))
    keys = ["edition_id", "surah", "ayah", "start", "stop"]
    ends = source.select(*keys, F.explode(F.array(F.struct(F.col("start").alias("pos"), F.lit(False).alias("end")), F.struct(F.col("stop").alias("pos"), F.lit(True).alias("end")))).alias("_e")).select(*keys, "_e.*")
    found = assign_by_range(ends, blocks, ["edition_id", "surah"], "pos", ("at", "src_end"), ["tag", "src_start", "src_end", "dest_start", "dest_end"])
    there = found.select(*keys, F.coalesce(carried(F.col("pos"), F.col("end")), F.lit(0)).cast("long").alias("_to"))
    return there.groupBy(*keys).agg(F.min("_to").alias("dest_start"), F.max("_to").alias("dest_stop"))


def map_editions(ayat: DataFrame, reference: int = 1, coverage: float = 0.0, skip_first: bool = True, normal: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(mapping, violations): edition_id, surah, ayah, hafs_ayah for all verses; the reference's verses map to themselves.

    With ``skip_first`` the reference's first verse of chapter 1 is no target for other editions. With a ``coverage``
    a reference verse must have that share of itself overlapped, or hold an end of the span; any overlap does by
    default. A verse without a correspondence is a violation. Texts are compared in their ``normal`` form, by default the
    mapping's.
    """
    spans = verse_spans(ayat, normal)
    own = F.col("edition_id") == reference
    skipped = own & (F.col("surah") == 1) & (F.col("ayah") == F.col("_first"))
    first = ayat.filter(own & (F.col("surah") == 1)).agg(F.min("ayah").alias("_first"))
    base = ayat.filter(own).join(F.broadcast(first)) if skip_first else None  # one row
    target = verse_spans(base.filter(~F.coalesce(skipped, F.lit(False))) if skip_first else ayat.filter(own), normal).drop("edition_id")
    target = target.toDF(*target.columns)  # columns of their own, as both sides come from one table
    moved = mapped_spans(spans.filter(~own), target)
    goal = target.select("surah", F.col("ayah").alias("hafs_ayah"), F.col("start").alias("t_start"), F.col("stop").alias("t_stop"))
    pairs = overlap_join(moved, goal, ["surah"], ("dest_start", "dest_stop"), ("t_start", "t_stop"))
    if coverage > 0:
        share = (F.least("dest_stop", "t_stop") - F.greatest("dest_start", "t_start")) / F.greatest(F.lit(1), F.col("t_stop") - F.col("t_start"))
        ends = ((F.col("t_start") <= F.col("dest_start")) & (F.col("dest_start") < F.col("t_stop"))) | ((F.col("t_start") < F.col("dest_stop")) & (F.col("dest_stop") <= F.col("t_stop")))
        pairs = pairs.filter((share >= coverage) | ends)
    rows = pairs.select("edition_id", "surah", "ayah", "hafs_ayah").distinct()
    identity = ayat.filter(own).select("edition_id", "surah", "ayah", F.col("ayah").alias("hafs_ayah"))
    lost = moved.join(rows, ["edition_id", "surah", "ayah"], "left_anti").select(F.lit("verse_without_reference").alias("rule"), T.key("edition_id", "surah", "ayah").alias("key"), F.lit("").alias("detail"))
    return identity.unionByName(rows), lost


def references(mapping: DataFrame, edition_id: int, surah: int, ayah: int) -> DataFrame:
    """The ordered references of one verse."""
    return mapping.filter((F.col("edition_id") == edition_id) & (F.col("surah") == surah) & (F.col("ayah") == ayah)).select("hafs_ayah").orderBy("hafs_ayah")


def multiple_references(mapping: DataFrame) -> DataFrame:
    """Verses with several references."""
    grouped = mapping.groupBy("edition_id", "surah", "ayah").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("hafs_ayah")).alias("refs"))
    return grouped.filter("n > 1")


def build_report(mapping: DataFrame, editions: DataFrame, examples: int = 50) -> DataFrame:
    """One row: counts, editions and the first verses with several references."""
    multi = multiple_references(mapping)
    some = multi.orderBy("edition_id", "surah", "ayah").limit(examples).agg(F.array_sort(F.collect_list(F.struct("edition_id", "surah", "ayah", "refs"))).alias("multi_reference_examples"))
    total = mapping.agg(F.count("*").alias("row_count"))
    n = multi.agg(F.count("*").alias("multi_reference_ayah_count"))
    of = editions.agg(F.array_sort(F.collect_list(F.struct(*editions.columns))).alias("editions"))
    row = total.join(F.broadcast(n)).join(F.broadcast(some)).join(F.broadcast(of))  # one row each
    return row.withColumn("algorithm", F.struct(F.lit("character-span-alignment").alias("method"), F.lit("arabic-nfkc-marks-v1").alias("normalization"), F.lit(0.5).alias("min_target_coverage"), F.lit(0.0).alias("min_span_coverage"), F.lit(False).alias("numeric_offset")))
