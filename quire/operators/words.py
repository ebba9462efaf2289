"""The word stream of editions: tokens, verse-wise and page-wise numbers, positions, matching forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators.streams import blocks, ordinal, prefix_sums, stream_part


def explode_parts(df: DataFrame, text: str, leading: bool = True) -> DataFrame:
    """A row for each word or number in a text: raw_pos, sub_pos, token, marker."""
    raw = df.select("*", F.posexplode(T.tokens(F.col(text))).alias("raw_pos", "_raw"))
    parts = raw.select("*", F.posexplode(T.split_token(F.col("_raw"), leading)).alias("sub_pos", "_part"))
    return parts.select("*", F.col("_part.token").alias("token"), F.col("_part.marker").alias("marker")).drop("_raw", "_part")


def numbered_tokens(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """The columns ``keep`` with a row for each token of a text: word_no (from 1) and word. A row's tokens are numbered
    where they are, without a shuffle."""
    return df.select(*keep, F.posexplode(T.tokens(F.col(text))).alias("_k", "word")).select(*keep, (F.col("_k") + 1).cast("long").alias("word_no"), "word")


#: Words of a verse that are one row until they are placed, at most.
BLOCK = 64


def words(ayat: DataFrame) -> DataFrame:
    """edition_id, surah, ayah, page, wordIndex (from 1 in a verse, numbers and signs not counted), word, pos (from 0
    in the edition), at (characters of the loose forms before it in the edition), canonical, loose, f (the form for
    distances). Null texts have no words. The words of several rows of one verse go by their places in their texts.

    Blocks of a verse's words are rows until they are placed, so that the texts are split once and dealt once.
    """
    one = lambda p: F.struct(p["token"].alias("word"), F.length(T.canonical_loose(p["token"])).alias("size"))
    split = ayat.select(stream_part(["edition_id"], "surah"), "ayah", "page", F.transform(F.filter(T.split_line(F.col("text")), lambda p: p["token"] != ""), one).alias("_all"))
    parts = split.select("_stream", "ayah", "page", F.posexplode(blocks("_all", BLOCK)).alias("_block", "_all"))
    parts = parts.select("_stream", "ayah", "_block", F.transform("_all", lambda w, i: F.struct(i.alias("no"), F.col("page"), w["word"].alias("word"), w["size"].alias("size"))).alias("_all"))
    merged = parts.repartition("_stream").groupBy("_stream", "ayah", "_block").agg(F.collect_list("_all").alias("_all"))
    merged = merged.select("_stream", "ayah", "_block", F.when(F.size("_all") == 1, F.col("_all")[0]).otherwise(F.array_sort(F.flatten("_all"))).alias("_all"))
    in_verse = F.sum(F.size("_all")).over(W.partitionBy("_stream", "ayah").orderBy("_block").rowsBetween(W.unboundedPreceding, 0)) - F.size("_all")
    numbered = merged.select("*", in_verse.alias("_in_verse"))
    chars = F.aggregate("_all", F.lit(0).cast("long"), lambda n, w: n + w["size"])
    placed = prefix_sums(numbered, {"_pos": F.size("_all"), "_at": chars}, ["edition_id"], "surah", ["ayah", "_block"], ties=False)
    start = F.struct(F.lit(0).cast("long").alias("n"), F.array().cast("array<bigint>").alias("before"))
    sums = F.aggregate("_all", start, lambda s, w: F.struct((s["n"] + w["size"]).alias("n"), F.concat(s["before"], F.array(s["n"])).alias("before")), lambda s: s["before"])
    each = placed.select("edition_id", "surah", "ayah", "_in_verse", "_pos", "_at", F.posexplode(F.arrays_zip(F.col("_all").alias("w"), sums.alias("before"))).alias("_k", "_z"))
    each = each.select("*", F.col("_z.w.word").alias("word"))
    own = [F.col("_z.w.page").alias("page"), (F.col("_in_verse") + F.col("_k") + 1).cast("int").alias("wordIndex"), "word", (F.col("_pos") + F.col("_k")).alias("pos"), (F.col("_at") + F.col("_z.before")).alias("at")]
    word = F.col("word")
    return each.select("edition_id", "surah", "ayah", *own, T.canonical(word).alias("canonical"), T.canonical_loose(word).alias("loose"), T.fuzzy_canonical(word).alias("f"))


def page_positions(stream: DataFrame) -> DataFrame:
    """Adds page_pos, from 0 in each page."""
    return ordinal(stream, ["edition_id", "page"], ["pos"], "_n").withColumn("page_pos", (F.col("_n") - 1).cast("long")).drop("_n")


def verse_words(df: DataFrame) -> DataFrame:
    """For checks: words of verses split at white space, with their global positions."""
    return words(df).select("edition_id", "surah", "ayah", "wordIndex", "word", "canonical", "pos")


def chapter_counts(ayat: DataFrame) -> DataFrame:
    return ayat.groupBy("edition_id", "surah").agg(F.count("*").alias("n"))


def inline_numbering(parts: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Verse and word numbers from markers inside the text.

    ``parts`` (token, marker) of a chapter in order: a word's verse is the last marker's plus 1 (1 before any), and
    word numbers start anew after a marker; a marker's verse is its own number.
    """
    from quire.operators.streams import last_known, running

    is_marker = F.col("marker").isNotNull()
    marked = parts.withColumn("_last", last_known("marker", keys, order)).withColumn("_group", running(is_marker.cast("int"), keys, order, before=True))
    word_no = running((~is_marker).cast("int"), [*keys, "_group"], order)
    return marked.withColumn("ayah", F.when(is_marker, F.col("marker")).otherwise(F.coalesce(F.col("_last") + 1, F.lit(1)))).withColumn("wordIndex", F.when(~is_marker, word_no.cast("int"))).drop("_last", "_group")
