"""Exact duplicates against a minimal perfect hash of the digests of earlier documents.

A text's digest is the SHA-256 of its UTF-8 bytes with A-Z in lower case. The distinct digests of the historical documents
are dealt into shards, and each shard gets a minimal perfect hash: a cascade of bit tables, twice as large as the digests
that are left, in which a digest's bit is set where no other digest of its level falls; the rank of the bit is the slot.
Slots hold the whole digest, the locator of the winner (document, batch, row) and the number of its documents. A lookup
compares all 32 bytes of the slot, so that a digest that the index doesn't hold, which the hash sends somewhere too, is
never taken for a member. Members join the group of their slot; nonmembers form groups of their own.

Of equal texts the row with the largest doc_id stays; a null id is smaller than all, and of rows that tie one stays. A
null text is the empty text. Empty tables give no rows; extra columns are not read.

Texts are read once, where they lie; only digests are shuffled, pre-aggregated, so that a text that fills a third of the
table is one row of each task. A shard's size is set by the count of rows and does not grow with the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import drop_since, id_hash_mod, mark, small_batches, text_of, tidied, write_table
from ._text import LOWER, mix, raw

#: Digests of a shard, on average.
SHARD = 65_536
#: Groups that hold more than this share of all rows are joined by broadcast: there can't be more than its inverse.
HEAVY = 1 / 4096

ROWS = "doc_id bigint, batch int, row bigint, digest binary"
INDEX = "shard int, levels array<int>, bits binary, digests binary, winners array<struct<doc_id:bigint,batch:int,row:bigint>>, sizes array<bigint>"
GROUPS = "digest binary, winner struct<doc_id:bigint,batch:int,row:bigint>, size bigint"
WINNER = pa.struct([("doc_id", pa.int64()), ("batch", pa.int32()), ("row", pa.int64())])

EXACT_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
g AS (SELECT doc_id, sha256(norm) AS text_sha256 FROM d)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
 row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256 FROM g
"""


def digests(docs: DataFrame, batch: Column | int = 0) -> DataFrame:
    """A row for each of ``docs`` (doc_id, text): doc_id, batch, row (its number in this table) and digest. Written, as
    row numbers must stay as they are."""
    small_batches(docs.sparkSession)
    batch = batch if isinstance(batch, Column) else F.lit(batch)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), batch.cast("int").alias("batch"), F.monotonically_increasing_id().alias("row"), text_of().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = raw(b.column(3))
            plain = memoryview(LOWER[data])
            found = [hashlib.sha256(plain[low:high]).digest() for low, high in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(found, pa.binary())], names=["doc_id", "batch", "row", "digest"])

    return write_table(given.mapInArrow(tidied(run), ROWS), "digests")


def groups(rows: DataFrame) -> DataFrame:
    """The distinct digests of ``rows`` with their winners and sizes."""
    return rows.groupBy("digest").agg(F.max(F.struct("doc_id", "batch", "row")).alias("winner"), F.count("*").alias("size"))


def words_of(found: pa.Array) -> np.ndarray:
    """Digests as rows of four words."""
    return np.frombuffer(b"".join(found.to_pylist()), "<u8").reshape(-1, 4)


def place(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where digests fall in the table of a level; every word of the digest counts, with factors of the level's own."""
    factors = np.random.default_rng(level).integers(0, 2**63, 4, np.uint64) * np.uint64(2) + np.uint64(1)
    return (mix((words * factors).sum(axis=1, dtype=np.uint64)) % np.uint64(size)).astype(np.int64)


def perfect_hash(words: np.ndarray) -> tuple[list[int], np.ndarray]:
    """(sizes of the levels, bits of all levels) for distinct digests: each has one bit set that is its own."""
    sizes, tables, left = [], [], words
    while len(left):
        size = max(64, 2 * len(left))
        at = place(left, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        tables.append(alone)
        left = left[~alone[at]]
    return sizes, np.concatenate(tables) if tables else np.zeros(0, bool)


def slots(words: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """The slots of digests, 0 to n - 1; -1 for those that fall on no bit. Digests outside the index may get any."""
    out = np.full(len(words), -1, np.int64)
    rank = np.cumsum(bits) - 1
    left, base = np.arange(len(words)), 0
    for level, size in enumerate(sizes):
        at = base + place(words[left], level, size)
        hit = bits[at]
        out[left[hit]] = rank[at[hit]]
        left, base = left[~hit], base + size
    return out


def shard_of(n: int) -> Column:
    return F.pmod(F.hash("digest"), F.lit(n))


def shards_for(rows: DataFrame) -> int:
    return max(1, -(-rows.count() // SHARD))


def build_index(rows: DataFrame, n_shards: int | None = None) -> DataFrame:
    """The index of the digests of historical ``rows``, a row for each shard that has digests; written."""
    n = n_shards or shards_for(rows)

    def build(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        words = words_of(table.column("digest"))
        sizes, bits = perfect_hash(words)
        order = pa.array(np.argsort(slots(words, sizes, bits)))  # no two digests share a slot
        placed = table.take(order)
        row = {
            "shard": [table.column("shard")[0].as_py()],
            "levels": [sizes],
            "bits": [np.packbits(bits).tobytes()],
            "digests": [b"".join(placed.column("digest").to_pylist())],
            "winners": [placed.column("winner").to_pylist()],
            "sizes": [placed.column("size").to_pylist()],
        }
        kinds = [pa.int32(), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.list_(WINNER), pa.list_(pa.int64())]
        return pa.Table.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds, strict=True)], names=list(row))

    small_batches(rows.sparkSession)
    return write_table(groups(rows).withColumn("shard", shard_of(n)).groupBy("shard").applyInArrow(build, INDEX), "digest-index")


def look_up(found: DataFrame, index: DataFrame, n_shards: int) -> DataFrame:
    """The groups of ``found`` (digest, winner, size) and of the index together: a member is added to its slot, every
    nonmember is a group of its own, and slots that nobody asks for stay as they are."""

    def match(asked: pa.Table, held: pa.Table) -> pa.Table:
        digest, winner, size = (asked.column(c).to_pylist() for c in ("digest", "winner", "size"))
        if held.num_rows:
            shard = held.slice(0, 1).to_pylist()[0]
            whole = shard["digests"]
            own = [whole[k : k + 32] for k in range(0, len(whole), 32)]
            winners, sizes = list(shard["winners"]), list(shard["sizes"])
            length = sum(shard["levels"])
            bits = np.unpackbits(np.frombuffer(shard["bits"], np.uint8), count=length).astype(bool)
            for k, slot in enumerate(slots(words_of(asked.column("digest")), shard["levels"], bits).tolist() if digest else ()):
                if slot >= 0 and own[slot] == digest[k]:
                    winners[slot] = max(winners[slot], winner[k], key=order_of)
                    sizes[slot] += size[k]
                else:
                    own.append(digest[k])
                    winners.append(winner[k])
                    sizes.append(size[k])
            digest, winner, size = own, winners, sizes
        return pa.Table.from_arrays([pa.array(digest, pa.binary()), pa.array(winner, WINNER), pa.array(size, pa.int64())], names=["digest", "winner", "size"])

    asked = found.withColumn("shard", shard_of(n_shards)).groupBy("shard")
    return asked.cogroup(index.groupBy("shard")).applyInArrow(match, GROUPS)


def order_of(winner: dict) -> tuple:
    return winner["doc_id"] is not None, winner["doc_id"] or 0, winner["batch"], winner["row"]


def resolve(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """For each of ``rows``: doc_id, keep_id, group_size, kept, text_sha256 by the ``totals`` (digest, winner, size) of its
    group. Groups of more than HEAVY of all documents, 4,096 at most, are broadcast; the others are joined by digest."""
    # of the sum of sizes, as a group may hold documents of the index that are not among the rows
    every = totals.agg(F.sum("size")).first()[0] or 0
    heavy = F.col("size") > every * HEAVY
    found = totals.select(F.col("digest").alias("_digest"), "winner", "size")
    large = rows.join(F.broadcast(found.filter(heavy)), F.col("digest") == F.col("_digest"), "left")  # at most 1 / HEAVY rows
    small = large.filter("_digest IS NULL").select(*rows.columns).join(found.filter(~heavy), F.col("digest") == F.col("_digest"))
    both = large.filter("_digest IS NOT NULL").unionByName(small)
    kept = (F.col("batch") == F.col("winner.batch")) & (F.col("row") == F.col("winner.row"))
    return both.select("doc_id", F.col("winner.doc_id").alias("keep_id"), F.col("size").alias("group_size"), kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def dedup(rows: DataFrame, index: DataFrame, n_shards: int) -> DataFrame:
    """Repeats among new ``rows`` and of what the index of ``n_shards`` shards holds."""
    return resolve(rows, write_table(look_up(groups(rows), index, n_shards), "digest-groups"))


def dedup_documents(docs: DataFrame, history: Column | None = None) -> DataFrame:
    """All of ``docs`` with the row of their text that stays: those for which ``history`` holds are indexed, the others are
    looked up. By default the historical half is the one whose ids hash to an even number."""
    start = mark()
    spark = docs.sparkSession
    earlier = id_hash_mod("doc_id", 2) == 0 if history is None else F.coalesce(history, F.lit(False))
    rows = digests(docs, F.when(earlier, 0).otherwise(1))
    old, new = rows.filter("batch = 0"), rows.filter("batch = 1")
    n = shards_for(rows)
    index = build_index(old, n)
    totals = write_table(look_up(groups(new), index, n), "digest-groups")
    drop_since(spark, start, rows, totals)
    return resolve(rows, totals)
