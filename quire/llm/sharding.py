"""Shards by balanced label propagation.

Linked documents start in shards by hash. In each round a document sees, through its links, how many of its neighbours
every shard holds (joins of members with their links' counts) and asks for the shard with the most. A shard admits
as many bytes as want to leave it for the asker's shard, and what its quota leaves: its equal share of all bytes less
the linked bytes that it holds. When more ask than fit, a hash decides, and the rest stay until a later round. Documents without links cost no cut wherever they are, so that
they are placed last, in parcels, largest first into the lightest shard, which evens the sizes. Only then, if linked
documents alone leave shards uneven, do whole links and at last single documents move from heavy shards to light ones.

A link joins any number of documents and stands for all edges between them; pairs are never listed.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import drop_table, text_of, write_table

#: Salts of the joins on a link, of which one may hold a third of all documents.
SALTS = 32
#: Parcels of documents that are placed as one; the driver sees a number for each and shard.
PARCELS = 8192
#: Sizes count as even within this share of the mean.
EVEN = 0.0005
#: Documents in a bucket of the gapless numbering.
BUCKET = 20_000


def fraction(*columns: Column) -> Column:
    """A hash as a number in [0, 1)."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) / F.lit(float(1 << 40))


def parcel_of(column: str) -> Column:
    return F.pmod(F.xxhash64(F.col(column), F.lit("parcel")), F.lit(PARCELS)).cast("int")


def place(loads: list[int], sizes: list[tuple[int, int]]) -> dict[int, int]:
    """Largest parcels first, each to the lightest shard; changes ``loads``."""
    heap, out = [(load, s) for s, load in enumerate(loads)], {}
    heapq.heapify(heap)
    for size, parcel in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, s = heap[0]
        out[parcel] = s
        heapq.heapreplace(heap, (load + size, s))
    for load, s in heap:
        loads[s] = load
    return out


def even_out(loads: list[int], parcels: dict[int, list[tuple[int, int]]], limit: float) -> dict[tuple[int, int], int]:
    """Moves parcels (size, number) from the heaviest shard to the lightest while the gap is over ``limit`` and some
    parcel narrows it; changes ``loads``."""
    moves: dict[tuple[int, int], int] = {}
    for own in parcels.values():
        own.sort()
    while True:
        high, low = max(range(len(loads)), key=loads.__getitem__), min(range(len(loads)), key=loads.__getitem__)
        gap = loads[high] - loads[low]
        fitting = [k for k, (size, _) in enumerate(parcels.get(high, [])) if 0 < size < gap]
        if gap <= limit or not fitting:
            return moves
        k = min(fitting, key=lambda i: abs(2 * parcels[high][i][0] - gap))
        size, number = parcels[high].pop(k)
        moves[high, number] = low  # a parcel moves once
        loads[high] -= size
        loads[low] += size


def admitted(want: dict[tuple[int, int], int], free: list[float]) -> list[list[float]]:
    """The share of the bytes asked for that may go from each shard to each: what goes the other way too is swapped,
    and the room left in a shard is split between those who still ask for it."""
    n = len(free)
    swapped = {(a, b): min(x, want.get((b, a), 0)) for (a, b), x in want.items()}
    rest = [sum(x - swapped[a, b] for (a, b), x in want.items() if b == to) for to in range(n)]
    out = [[0.0] * n for _ in range(n)]
    for (a, b), x in want.items():
        more = (x - swapped[a, b]) * min(1.0, free[b] / rest[b]) if rest[b] else 0.0
        out[a][b] = (swapped[a, b] + more) / x
    return out


def propagate(vertices: DataFrame, members: DataFrame, n_shards: int, capacity: float, rounds: int) -> DataFrame:
    """(v, size, shard) of the linked vertices after at most ``rounds`` rounds.

    ``vertices`` (v, size), each v once; ``members`` (v, link), links of two members or more.
    """
    shards = range(n_shards)
    salted = members.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    labels = write_table(vertices.withColumn("shard", F.pmod(F.xxhash64("v", F.lit("first")), F.lit(n_shards)).cast("int")), "labels")
    for k in range(rounds):
        of_link = salted.join(labels, "v").groupBy("link").agg(F.array(*[F.sum((F.col("shard") == s).cast("long")) for s in shards]).alias("n"))
        spread = of_link.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        seen = salted.join(spread, ["link", "salt"]).groupBy("v").agg(F.array(*[F.sum(F.col("n")[s]) for s in shards]).alias("n"), F.min("link").alias("tie"))
        # ties go to the shard that the link's hash names first, the same for all its members
        turn = F.pmod(F.xxhash64("tie"), F.lit(n_shards))
        full = F.array(*[F.struct(F.col("n")[s].alias("neighbours"), F.pmod(F.lit(s) + turn, F.lit(n_shards)).alias("turn"), F.lit(s).alias("to")) for s in shards])
        load = {r.shard: r.b for r in labels.groupBy("shard").agg(F.sum("size").alias("b")).collect()}  # a row for each shard
        free = [max(0.0, capacity - load.get(s, 0)) for s in shards]
        # in turn: any shard, as others may leave it, and shards with room; the own shard always counts
        room = F.array(*[F.lit(k % 2 == 0 or x > 0) for x in free])
        target = F.array_max(F.filter(full, lambda x: F.element_at(room, x["to"] + 1) | (x["to"] == F.col("shard"))))["to"]
        asked = labels.join(seen, "v", "left").withColumn("to", F.when(F.col("n").isNull(), F.col("shard")).otherwise(target))
        gained = F.element_at("n", F.col("to") + 1) > F.element_at("n", F.col("shard") + 1) - 1
        asked = write_table(asked.withColumn("to", F.when(gained, F.col("to")).otherwise(F.col("shard"))).select("v", "size", "shard", "to"), "asked")
        want = {(r.shard, r.to): r.b for r in asked.filter("to <> shard").groupBy("shard", "to").agg(F.sum("size").alias("b")).collect()}  # a row for each pair of shards
        if not want and k % 2 == 0:
            drop_table(asked)
            break
        share = admitted(want, free)
        goes = fraction(F.col("v"), F.lit(k)) < F.element_at(F.element_at(F.array(*[F.array(*map(F.lit, row)) for row in share]), F.col("shard") + 1), F.col("to") + 1)
        fresh = write_table(asked.select("v", "size", F.when(goes, F.col("to")).otherwise(F.col("shard")).alias("shard")), "labels")
        drop_table(labels)
        drop_table(asked)
        labels = fresh
    return labels


def shard(vertices: DataFrame, members: DataFrame, n_shards: int = 8, rounds: int = 8) -> DataFrame:
    """(v, size, shard, linked) of all vertices, sizes near equal.

    ``vertices`` (v, size), each v once; ``members`` (v, link), any number of links for a vertex. Links of one member
    join nothing. An empty table gives an empty one.
    """
    total = vertices.agg(F.sum("size")).first()[0] or 0
    joined = members.groupBy("link").agg(F.min("v").alias("low"), F.max("v").alias("high")).filter("low < high").select("link", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    members = write_table(members.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(joined, ["link", "salt"]).select("v", "link"), "members")
    linked = members.groupBy("v").agg(F.min("link").alias("link"))
    marked = write_table(vertices.join(linked, "v", "left"), "vertices")
    labels = propagate(marked.filter("link is not null").select("v", "size"), members, n_shards, total / n_shards, rounds)

    loads = [0] * n_shards
    for r in labels.groupBy("shard").agg(F.sum("size").alias("b")).collect():
        loads[r.shard] = r.b
    loose = marked.filter("link is null").select("v", "size")
    # at most PARCELS rows, and PARCELS for each shard
    parcels = loose.groupBy(parcel_of("v").alias("parcel")).agg(F.sum("size").alias("b")).collect()
    put = place(loads, [(r.b, r.parcel) for r in parcels])
    limit = EVEN * total / n_shards
    for by in ("link", "v"):
        if max(loads) - min(loads) <= limit:
            break
        rows = labels if by == "v" else labels.join(linked, "v")
        held: dict[int, list[tuple[int, int]]] = {}
        for r in rows.groupBy("shard", parcel_of(by).alias("parcel")).agg(F.sum("size").alias("b")).collect():
            held.setdefault(r.shard, []).append((r.b, r.parcel))
        moves = even_out(loads, held, limit)
        if moves:
            to = F.broadcast(vertices.sparkSession.createDataFrame([(s, p, t) for (s, p), t in moves.items()], "shard int, parcel int, to int"))  # at most n_shards * PARCELS rows
            labels = write_table(rows.withColumn("parcel", parcel_of(by)).join(to, ["shard", "parcel"], "left").select("v", "size", F.coalesce("to", "shard").alias("shard")), "labels")
    table = F.broadcast(vertices.sparkSession.createDataFrame(sorted(put.items()), "parcel int, shard int"))  # at most PARCELS rows
    settled = loose.withColumn("parcel", parcel_of("v")).join(table, "parcel").select("v", "size", "shard", F.lit(False).alias("linked"))
    return labels.select("v", "size", "shard", F.lit(True).alias("linked")).unionByName(settled)


def numbered(rows: DataFrame, n: int, order: list[str], out: str = "slot") -> DataFrame:
    """Adds a gapless number from 0 within each shard; ``rows`` has a shard and a hash ``h``.

    Rows are numbered within buckets of about BUCKET rows and the buckets' sizes are summed up, so that a shard never
    meets in one task.
    """
    from pyspark.sql import Window as W

    buckets = max(1, -(-n // BUCKET))
    rows = rows.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    sizes = rows.groupBy("shard", "bucket").agg(F.count("*").alias("held"))
    before = sizes.withColumn("before", F.sum("held").over(W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))).select("shard", "bucket", F.coalesce("before", F.lit(0)).alias("before"))
    ranked = rows.withColumn("rank", F.row_number().over(W.partitionBy("shard", "bucket").orderBy(*order)))
    return ranked.join(before, ["shard", "bucket"]).withColumn(out, (F.col("before") + F.col("rank") - 1).cast("long")).drop("before", "rank", "bucket")


def shard_documents(docs: DataFrame, n_shards: int = 8, rounds: int = 8) -> DataFrame:
    """Shards of all rows of ``docs`` (doc_id, text), equal texts linked: doc_id, size, text_crc32, law, shard, slot,
    grown_shard, linked.

    Size is the text's UTF-8 bytes plus 1; a null text has size 1 and the crc32 of the empty text, and is linked to
    the empty texts. Repeated rows go to one shard. Other columns are not read. The law is ``bytes``.
    """
    text = text_of("text").cast("binary")
    rows = write_table(docs.select(F.col("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(F.sha2(text, 256)).alias("link")).withColumn("v", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "link")), "rows")
    vertices = rows.groupBy("v", "link").agg(F.sum("size").alias("size"))
    placed = shard(vertices.select("v", "size"), vertices.select("v", "link"), n_shards, rounds).select("v", "shard", "linked")
    with_shard = write_table(rows.join(placed, "v"), "sharded")
    out = numbered(with_shard.withColumn("h", F.col("v")), with_shard.count(), ["v", "doc_id"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "linked")
