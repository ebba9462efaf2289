"""Near-duplicates by ProbMinHash.

Shingles of SHINGLE words are weighted by 1 + ln(times). Each shingle is a Poisson process of arrivals with its weight
as rate, seeded by its hash; every arrival falls on one of M registers, which keep their earliest arrival and its
shingle. A shingle is left as soon as its next arrival is later than all registers hold. Registers of two texts agree
with the probability Jaccard of their weights. BANDS bands of ROWS registers send texts to buckets. A text that repeats
shingles goes to the buckets of its set too, by registers in which all weights are 1, as copies may differ in repeats
alone. What meets in a bucket is verified: two texts are linked if their sets of shingles have a Jaccard of at least
0.8.

Texts with the same set of shingles are one node. In each bucket all nodes are compared with the one that meets most
others, then, where a bucket still has several components, with one of another component, in several rounds while many
pairs are left. What is left then is compared node by node in blocks within tasks, by sets, and tasks emit links alone.
Buckets of more than a block are dealt out anew before: two sets that reach the threshold share one of the shingles that
come first in any order of all shingles, as many as a set may lack and one more, so that the nodes of such buckets go to
groups by these, rare shingles first. So a bucket of thousands of copies costs as many comparisons as it has members, one
of thousands of unlike variants of a template as many as share rare shingles, and no link between different texts that
meet in a bucket is lost. A class is a connected component.

Sets are compared by 32-bit hashes of their shingles.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import drop_since, mark, small_batches, text_of, tidied, write_table
from ._text import mix, raw, words

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 5
M = BANDS * ROWS
#: Bytes of text that one call works on.
GATHER = 4 << 20
#: Texts that one call works on, at most; their number and a shingle's hash share 64 bits.
MOST = 1 << 13
HASH_BITS = np.uint64(51)
SHORT = HASH_BITS - np.uint64(32)
#: Nodes in a block of the exhaustive comparison.
BLOCK = 1024
#: Counts by which shingles are ordered, rare ones first, when large buckets are dealt out: each is that of all shingles
#: whose hashes end alike. They decide how small the groups are, not which links are found.
SLOTS = 1 << 16
#: Rounds of stars before the exhaustive comparison, at most, and the pairs left for each place in a bucket at which it
#: comes at once. Both move work only: what stars do not link is compared node by node.
MOST_STARS, FEW_PAIRS = 4, 256
#: Ids up to which they are sent to all tasks: 24 bytes each.
MOST_SENT = 500_000

_odd = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def gathered(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches joined until a text column has GATHER bytes."""
    held, size, rows = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column(column).nbytes
        rows += batch.num_rows
        if size >= GATHER or rows > MOST - 1024:
            yield from joined(held)
            held, size, rows = [], 0, 0
    if held:
        yield from joined(held)


def joined(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole = pa.Table.from_batches(held).combine_chunks()
    for batch in whole.to_batches(max_chunksize=MOST):
        yield batch


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, texts, times) of the distinct shingles of each text, sorted by text and hash.

    A text of fewer words than a shingle has one shingle of all of them; a text without words has none.
    """
    h, of, _ = words(*raw(texts))
    n = len(texts)
    sizes = np.bincount(of, minlength=n)
    parts = np.zeros(len(h), np.uint64)
    for k in range(SHINGLE):
        if len(h) > k:
            parts[: len(h) - k] += h[k:] * _odd[k]
    first = np.cumsum(sizes) - sizes
    place = np.arange(len(h)) - first[of]
    full = place <= sizes[of] - SHINGLE
    own, whose = mix(parts[full]), of[full]
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    if len(short):
        few = np.array([mix(np.array([sum(int(h[first[t] + k]) * int(_odd[k]) for k in range(sizes[t])) & (1 << 64) - 1 ^ int(sizes[t])], np.uint64))[0] for t in short], np.uint64)
        own, whose = np.concatenate((own, few)), np.concatenate((whose, short))
    keys = np.sort(whose.astype(np.uint64) << HASH_BITS | own >> (np.uint64(64) - HASH_BITS))
    if not len(keys):
        return keys, np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    times = np.diff(at, append=len(keys))
    keys = keys[at]
    return keys & ((np.uint64(1) << HASH_BITS) - np.uint64(1)), (keys >> HASH_BITS).astype(np.int64), times


def registers(hashes: np.ndarray, of: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """The shingle that each of M registers holds, for each of n texts: ProbMinHash with early termination."""
    times, held = np.full(n * M, np.inf), np.zeros(n * M, np.uint64)
    seeds, at, rate, arrival = mix(hashes + _odd[0]), of * M, 1.0 / weights, np.zeros(len(hashes))
    while len(hashes):
        seeds = seeds + _odd[1]
        draw = mix(seeds)
        arrival = arrival - np.log(((draw >> np.uint64(12)) + np.uint64(1)) * 2.0**-52) * rate
        slot = at + ((draw & np.uint64(0xFFF)) * np.uint64(M) >> np.uint64(12)).astype(np.int64)
        np.minimum.at(times, slot, arrival)
        won = times[slot] == arrival
        held[slot[won]] = hashes[won]
        texts = at // M
        first = np.concatenate(([True], texts[1:] != texts[:-1]))
        latest = times.reshape(n, M)[texts[first]].max(1)[np.cumsum(first) - 1]
        on = arrival < latest
        hashes, seeds, at, rate, arrival = hashes[on], seeds[on], at[on], rate[on], arrival[on]
    return held.reshape(n, M)


def set_keys(hashes: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """A hash of each text's set of shingles; 0 for none."""
    total = np.zeros(n, np.uint64)
    np.add.at(total, of, mix(hashes + _odd[2]))
    return np.where(total > 0, mix(total), np.uint64(0)).view(np.int64)


def sign(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, node, bands, more): a hash of the text and one of its set, a hash of each band of the set, and
    those hashes of the weighted bands that are others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.arange(1, BANDS + 1, dtype=np.uint64))

        def bands_of(own: np.ndarray) -> np.ndarray:
            bands = np.zeros((len(own), BANDS), np.uint64)
            for k in range(ROWS):
                bands = mix(bands + own[:, k::ROWS] * _odd[k])
            return mix(bands + salt)

        def lists(bands: np.ndarray, wanted: np.ndarray) -> pa.ListArray:
            cuts = np.concatenate(([0], np.cumsum(wanted.sum(1)))).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(cuts), pa.array(bands[wanted].view(np.int64)))

        for batch in gathered(batches, 1):
            n = batch.num_rows
            h, of, times = shingles(batch.column(1))
            bands = bands_of(registers(h, of, np.ones(len(h)), n))
            weighted = bands.copy()
            repeats = np.bincount(of, times > 1, minlength=n) > 0
            if repeats.any():  # without repeats both are the same
                mine = repeats[of]
                weighted[repeats] = bands_of(registers(h[mine], (np.cumsum(repeats) - 1)[of[mine]], 1.0 + np.log(times[mine]), int(repeats.sum())))
            some = np.bincount(of, minlength=n) > 0
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(set_keys(h, of, n)), lists(bands, np.repeat(some[:, None], BANDS, 1)), lists(weighted, weighted != bands)], names=["doc_id", "tie", "node", "bands", "more"])

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = text_of("text")
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tie")).mapInArrow(tidied(run), f"doc_id {kind}, tie bigint, node bigint, bands array<bigint>, more array<bigint>")


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the wanted (doc_id, tie, node): the sorted hashes of their sets. Null ids are equal here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, 0):
            n = batch.num_rows
            h, of, _ = shingles(batch.column(0))
            keys = set_keys(h, of, n)
            cuts = np.searchsorted(of, np.arange(n + 1))
            right = np.flatnonzero(keys == batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(keys[right]), pa.array([np.unique((h[cuts[k] : cuts[k + 1]] >> SHORT).astype(np.uint32)).tobytes() for k in right], pa.binary())], names=["node", "shingles"])

    wanted = wanted.toDF("_doc_id", "_tie", "node")
    if wanted.count() <= MOST_SENT:
        wanted = F.broadcast(wanted)
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", text_of("text").alias("text"), F.xxhash64(text_of("text")).alias("tie"))
    given = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("tie") == F.col("_tie"))).select("text", "node")
    return write_table(given.mapInArrow(tidied(run), "node bigint, shingles binary").dropDuplicates(["node"]), "sets")


def alike(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets, as sorted arrays, reach the threshold."""
    if min(len(x), len(y)) < THRESHOLD * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= THRESHOLD * (len(x) + len(y) - both)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sets have a Jaccard of at least THRESHOLD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets_of_pairs = zip(batch.column(2), batch.column(3), strict=True)
            at = pa.array([k for k, (x, y) in enumerate(sets_of_pairs) if alike(np.frombuffer(x.as_buffer(), np.uint32), np.frombuffer(y.as_buffer(), np.uint32))], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])

    left, right = sets.withColumnsRenamed({"node": "a", "shingles": "x"}), sets.withColumnsRenamed({"node": "b", "shingles": "y"})
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return write_table(rows.mapInArrow(tidied(run), "a bigint, b bigint"), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes that have links: the smallest node of each component.

    Every node goes to its smallest neighbour, twice over; links are redrawn between where their ends went, and those
    within one place fall away, until none is left. At least half of the places go in a round.
    """
    links = write_table(links.filter("a <> b").distinct(), "links")
    labels = links.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    first = True
    while links.limit(1).count():
        up = links.union(links.select("b", "a")).groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("up"))
        up = write_table(up, "up")
        up = write_table(up.join(up.toDF("_at", "_up"), F.col("up") == F.col("_at")).select("node", F.col("_up").alias("up")), "up")
        if first:
            labels = up.withColumnRenamed("up", "component")
        else:
            labels = labels.join(up.toDF("_at", "_up"), F.col("component") == F.col("_at"), "left").select("node", F.coalesce("_up", "component").alias("component"))
        labels, first = write_table(labels, "labels"), False
        moved = links.join(up.toDF("a", "_a"), "a").join(up.toDF("b", "_b"), "b").filter("_a <> _b")
        links = write_table(moved.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "links")
    return labels


def starred(members: DataFrame, turn: int) -> DataFrame:
    """(a, b): in each bucket of ``members`` (bucket, node, component, weight), a node that is not of the component of
    the bucket's heaviest node, if there are two, with all nodes of other components. The first turn takes the heaviest
    such node, later ones others by hash."""
    first = members.groupBy("bucket").agg(F.max_by("component", F.struct("weight", "node")).alias("main"), F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    others = members.join(first.select("bucket", "main"), "bucket")
    rank = F.struct("weight", "node") if turn == 0 else F.struct(F.xxhash64("node", F.lit(turn)), "node")
    picked = others.filter("component <> main").groupBy("bucket").agg(F.max_by(F.struct("node", "component"), rank).alias("s")).select("bucket", F.col("s.node").alias("b"), F.col("s.component").alias("of"))
    return members.join(picked, "bucket").filter("component <> of").select(F.col("node").alias("a"), "b").distinct()


def pairs_left(members: DataFrame) -> float:
    """The pairs of nodes in buckets that still hold several components."""
    mixed = members.groupBy("bucket").agg(F.count("*").cast("double").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    return mixed.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0] or 0.0


def leading(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles of a set by rarity, then hash: as many as it may lack in a likeness of THRESHOLD, and one.

    Of two sets that reach it, each has THRESHOLD of its shingles, rounded up, in common with the other; the first common
    one cannot come later, as too few come after."""
    common = math.ceil(THRESHOLD * len(shingles) - 1e-6)
    order = np.lexsort((shingles, counts[shingles & np.uint32(SLOTS - 1)]))
    return shingles[order[: len(shingles) - common + 1]]


def regrouped(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(bucket, node, component): what of ``members`` is still to be compared. Buckets of BLOCK nodes at most stay; the
    nodes of larger ones go to groups by their leading shingles, in which all links among them meet."""
    mixed = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("bucket", "n")
    held = write_table(members.join(mixed, "bucket").select("bucket", "node", "component", (F.col("n") > BLOCK).alias("large")), "mixed")
    small = held.filter("not large").select("bucket", "node", "component")
    if not held.filter("large").limit(1).count():
        return small
    nodes = write_table(held.filter("large").select("node", "component").distinct().join(sets, "node"), "large")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for x in batch.column(0):
                total += np.bincount(np.frombuffer(x.as_buffer(), np.uint32) & np.uint32(SLOTS - 1), minlength=SLOTS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["slot", "n"])

    counts = np.zeros(SLOTS, np.int64)
    for r in nodes.select("shingles").mapInArrow(count, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).collect():  # SLOTS rows at most
        counts[r.slot] = r.n

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [leading(np.frombuffer(x.as_buffer(), np.uint32), counts) for x in batch.column(2)]
            if found:
                row = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).astype(np.int64)), batch.column(0).take(row), batch.column(1).take(row)], names=["bucket", "node", "component"])

    groups = nodes.select("node", "component", "shingles").mapInArrow(tidied(deal), "bucket bigint, node bigint, component bigint")
    return write_table(small.union(groups), "groups")


def remaining(members: DataFrame, sets: DataFrame) -> DataFrame:
    """The links (a, b) between different components that share a bucket.

    Buckets are cut into blocks of BLOCK nodes, and tasks compare blocks with blocks: a pair in every bucket that it
    shares, by sets.
    """
    mixed = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    rows = members.join(mixed, "bucket").join(sets, "node").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "component", "shingles")

    def compare(part: list[tuple]) -> Iterator[tuple[int, int]]:
        _, i, j, *_ = part[0]
        comps = np.array([x[5] for x in part])
        if (comps == comps[0]).all():
            return
        nodes, own = np.array([x[4] for x in part]), np.array([x[3] for x in part])
        sizes = np.array([len(x[6]) // 4 for x in part])
        every = np.frombuffer(b"".join(x[6] for x in part), np.uint32)
        # numbers of the shingles; what only one set of the part has is left out
        numbers, times = np.unique(every, return_inverse=True, return_counts=True)[1:]
        kept = times[numbers] > 1
        starts = np.concatenate(([0], np.cumsum(kept)))[np.concatenate(([0], np.cumsum(sizes)))]
        numbers = numbers[kept].astype(np.int32)
        flags = np.zeros(len(times) + 1, bool)
        for k in range(len(part)):
            if i == j:
                others = np.arange(k + 1, len(part))
            elif own[k] == i:
                others = np.flatnonzero(own == j)
            else:
                continue
            others = others[comps[others] != comps[k]]
            others = others[np.minimum(sizes[others], sizes[k]) >= THRESHOLD * np.maximum(sizes[others], sizes[k])]
            mine = numbers[starts[k] : starts[k + 1]]
            if not len(others) or not len(mine):
                continue
            flags[mine] = True
            first, end = others[0], others[-1] + 1
            hits = np.concatenate(([0], np.cumsum(flags[numbers[starts[first] : starts[end]]], dtype=np.int32)))
            both = hits[starts[others + 1] - starts[first]] - hits[starts[others] - starts[first]]
            flags[mine] = False
            for x in others[both >= THRESHOLD * (sizes[others] + sizes[k] - both)]:
                yield min(nodes[k], nodes[x]), max(nodes[k], nodes[x])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part and row[:3] != part[0][:3]:
                    yield pairs_of(set(compare(part)))
                    part = []
                part.append(row)
        if part:
            yield pairs_of(set(compare(part)))

    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartition(tasks, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return write_table(placed.mapInArrow(tidied(run), "a bigint, b bigint").distinct(), "links")


def pairs_of(found: set[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def head_of() -> Column:
    """What the first row of a class has the smallest of: its id, null last, and its text's hash."""
    return F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tie")


def link(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(signed, classes): each row's (doc_id, tie, node), and (node, class_id, class_tie) of every node; a class's id is
    its smallest doc_id, and its tie the smallest hash of a text of that id."""
    start = mark()
    signed = write_table(sign(docs), "signed")
    nodes = write_table(signed.groupBy("node").agg(F.min(head_of()).alias("head"), F.min("bands").alias("bands")).select("node", F.col("head.doc_id").alias("doc_id"), F.col("head.tie").alias("tie"), "bands"), "nodes")
    buckets = nodes.select("node", F.explode("bands").alias("bucket")).union(signed.select("node", F.explode("more").alias("bucket")).distinct())
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("n")).filter("low < high").select("bucket", "n")
    members = write_table(buckets.join(shared, "bucket").select("bucket", "node", "n"), "members")
    weights = members.groupBy("node").agg(F.sum("n").alias("weight"))
    members = write_table(members.join(weights, "node").select("bucket", "node", "weight"), "members")
    met = write_table(nodes.select("node", "doc_id", "tie").join(weights.select("node"), "node", "left_semi"), "met")
    sets = sets_of(docs, met.select("doc_id", "tie", "node"))

    hubs = members.groupBy("bucket").agg(F.max_by("node", F.struct("weight", "node")).alias("b"))
    links = verified(members.join(hubs, "bucket").filter("node <> b").select(F.col("node").alias("a"), "b").distinct(), sets)
    turn, last = 0, False
    while not last:
        labels = components(links)
        known = write_table(members.join(labels, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"), "weight"), "members")
        last = turn > 0 and (turn == MOST_STARS or pairs_left(known) <= FEW_PAIRS * max(1, known.count()))
        more = remaining(regrouped(known, sets), sets) if last else verified(starred(known, turn), sets)
        # a component found is a star from now on
        links, turn = labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more), turn + 1
    labels = components(links)
    placed = nodes.select("node", "doc_id", "tie").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    heads = placed.groupBy("component").agg(F.min(head_of()).alias("head"))
    classes = placed.join(heads, "component").select("node", F.col("head.doc_id").alias("class_id"), F.col("head.tie").alias("class_tie"))
    classes = write_table(classes, "classes")
    drop_since(docs.sparkSession, start, signed, classes)
    return signed.select("doc_id", "tie", "node"), classes


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id and class_id of every row of ``docs`` (doc_id, text): the smallest doc_id of its class.

    Words are split at ASCII spaces, A-Z count as a-z. Texts without words (null, empty, blank) are one class; a text
    of fewer than five words has one shingle of all of them. Repeated rows are in one class. Other columns are not
    read.
    """
    signed, classes = link(docs)
    return signed.join(classes, "node").select("doc_id", "class_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class of near-duplicates, that of the smallest doc_id (nulls last) and text hash, with all
    columns of ``docs``. Of repeated rows one stays."""
    names, at = docs.columns, [f"{c}_{uuid.uuid4().hex[:8]}" for c in ("id", "tie", "of", "n")]
    signed, classes = link(docs)
    judged = write_table(signed.join(classes, "node").select("doc_id", "tie", (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("tie") == F.col("class_tie"))).alias("stays")), "judged")
    gone = judged.filter("not stays").select(F.col("doc_id").alias(at[0]), F.col("tie").alias(at[1])).distinct()
    if gone.count() <= MOST_SENT:
        gone = F.broadcast(gone)
    rows = docs.withColumn(at[2], F.xxhash64(text_of("text"))).join(gone, F.col("doc_id").eqNullSafe(F.col(at[0])) & (F.col(at[2]) == F.col(at[1])), "left_anti")
    repeated = judged.filter("stays").groupBy("doc_id", "tie").count().filter("count > 1").limit(1).count()
    if repeated:
        rows = rows.withColumn(at[3], F.row_number().over(W.partitionBy("doc_id", at[2]).orderBy(at[2]))).filter(F.col(at[3]) == 1)
    return rows.select(*[F.col(f"`{c}`") for c in names])
