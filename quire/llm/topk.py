"""Exact top-k inner products by norms, rotated partial sums and residual bounds.

Candidates are range-partitioned by descending length and packed into blocks, so that a block's first vector bounds
all of its others. All vectors are rotated once by the singular vectors of the candidates, which gathers most of an
inner product in the first HEAD coordinates. A query first meets the longest candidates and so gets a lower bound, its
current k-th score. A block of queries is then sent to those blocks alone whose longest vector, times the length of one
of its queries, reaches that query's score (Cauchy-Schwarz). There the partial sum over the first coordinates plus the
product of the lengths of the rests bounds each score, and only what may reach the k-th score is computed in full, from
the integers. Ties go to the smaller id, so that candidates that only equal the bound are kept.

Queries travel in blocks too. Every pair of a candidate block and a query block that may hold a result is one row of a
join on the candidate block's number; no pair of vectors is ever a row, and a task holds one block of each side at a
time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import drop_since, mark, small_batches, tidied, write_table

#: Vectors in a block of candidates and of queries.
CANDIDATES, QUERIES = 4096, 1024
#: Share of the rotated coordinates in the partial sum.
HEAD = 0.25
#: Relative slack for rounding in the bounds.
SLACK = 1e-9


def vectors(table: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, x): floor(scale * component) as doubles; rows without an id, and vectors that are null or have null or
    non-finite components, are left out."""
    x = F.transform(F.col(vector_col).cast("array<double>"), lambda c: F.floor(c * scale).cast("double"))
    finite = F.forall(F.col(vector_col).cast("array<double>"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return table.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).filter(finite).select(F.col(id_col).cast("long").alias("id"), x.alias("x"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]] if len(column) else np.zeros(0)
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width).astype(float)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def rotation(rows: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all candidates, from the sum of their outer products (width squared numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros((width, width))
        for batch in batches:
            x = matrix(batch.column(0), width)
            own += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(list(own))], names=["i", "row"])

    sums = rows.select("x").mapInArrow(tidied(run), "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    gram = np.zeros((width, width))
    for r in sums:
        gram[r.i, r.j] = r.v
    return np.linalg.eigh(gram)[1][:, ::-1]


PACKED = "part int, at int, n int, longest double, ids array<bigint>, data binary, heads binary, rests array<double>, norms array<double>"


def packed(rows: DataFrame, width: int, turn: np.ndarray, size: int, label: str) -> DataFrame:
    """Blocks (PACKED) of rows (id, x), each partition's rows in descending length: where the block stands (part, at),
    its ids and vectors, the first rotated coordinates, the lengths of the rests and of the whole vectors."""
    head = max(1, int(np.ceil(HEAD * width)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n, at, part = 0, 0, TaskContext.get().partitionId()

        def block(ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
            nonlocal at
            norms = np.linalg.norm(x, axis=1)
            order = np.argsort(-norms, kind="stable")
            ids, x, norms = ids[order], x[order], norms[order]
            turned = x @ turn
            at += 1
            values = [pa.array([k], pa.int32()) for k in (part, at - 1, len(ids))]
            lists = [pa.array([v], pa.list_(pa.float64())) for v in (np.linalg.norm(turned[:, head:], axis=1), norms)]
            return pa.RecordBatch.from_arrays([*values, pa.array([norms[0]]), pa.array([ids], pa.list_(pa.int64())), *[pa.array([m.astype("<f8").tobytes()], pa.binary()) for m in (x, turned[:, :head])], *lists], names=[c.split()[0] for c in PACKED.split(", ")])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append((batch.column(0).to_numpy(), matrix(batch.column(1), width)))
            n += batch.num_rows
            if n >= size:
                ids, x = np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held])
                full = n // size * size
                for k in range(0, full, size):
                    yield block(ids[k : k + size], x[k : k + size])
                held, n = [(ids[full:], x[full:])], n - full
        if n:
            yield block(np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held]))

    return write_table(rows.select("id", "x").mapInArrow(tidied(run), PACKED), label)


class Block:
    """A block's columns as arrays."""

    def __init__(self, ids, data, heads, rests, norms, width: int):
        self.ids, self.rests, self.norms = (c.values.to_numpy() for c in (ids, rests, norms))
        self.x = np.frombuffer(data.as_buffer(), "<f8").reshape(-1, width)
        self.heads = np.frombuffer(heads.as_buffer(), "<f8").reshape(len(self.x), -1)


def best_of(q: Block, floor: np.ndarray, c: Block, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query rows, candidate ids, scores): each query's best k of a block, of those that reach ``floor``."""
    for r in range(len(q.ids)):
        length = float(q.norms[r])
        scores_of, ids_of, low, at, step = np.zeros(0), np.zeros(0, np.int64), floor[r], 0, 4 * k
        while at < len(c.ids):
            slack = SLACK * (1 + length * c.norms[at])
            if length * c.norms[at] + slack < low:
                break  # all later ones are no longer
            part = slice(at, at + step)
            bound = c.heads[part] @ q.heads[r] + q.rests[r] * c.rests[part]
            may = at + np.flatnonzero(bound + slack >= low)
            may = may[c.ids[may] != q.ids[r]]
            if len(may):
                scores_of, ids_of = np.concatenate((scores_of, c.x[may] @ q.x[r])), np.concatenate((ids_of, c.ids[may]))
                if len(ids_of) > k:
                    top = np.lexsort((ids_of, -scores_of))[:k]
                    scores_of, ids_of = scores_of[top], ids_of[top]
                if len(ids_of) == k:
                    low = max(low, scores_of.min())
            at, step = at + step, min(4 * step, 4096)
        if len(ids_of):
            yield np.full(len(ids_of), r), ids_of, scores_of


SIDE = ("ids", "data", "heads", "rests", "norms")


def compared(pairs: DataFrame, width: int, k: int) -> DataFrame:
    """(query_id, vec_id, score) of pairs of blocks: SIDE of the candidates, SIDE of the queries with q_, floors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                c, q, floors = Block(*row[:5], width), Block(*row[5:10], width), row[10]
                floor = floors.values.to_numpy() if floors.is_valid else np.full(len(q.ids), -np.inf)
                found = list(best_of(q, floor, c, k))
                if found:
                    rows, vecs, scores = (np.concatenate(x) for x in zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(q.ids[rows]), pa.array(vecs), pa.array(scores.astype(np.int64))], names=["query_id", "vec_id", "score"])

    return pairs.select(*SIDE, *[f"q_{c}" for c in SIDE], "floors").mapInArrow(tidied(run), "query_id bigint, vec_id bigint, score bigint")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The best k of each query; tasks drop the rest of their own rows before the shuffle. Repeated rows stay."""
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(table: DataFrame, id_col: str, vector_col: str, every: int = 50, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by ``every`` the k other rows of the highest
    inner product of integer vectors, ties to the smaller id; fewer if there are fewer.

    Rows of the query's own id are no candidates; of a repeated candidate id each row counts; a repeated query id is
    one query, with its longest vector (of equally long ones the least). Vectors of fewer components end in zeros. An empty table gives no rows. Products must stay
    below 2 ** 53. Other columns are not read.
    """
    spark, made = table.sparkSession, mark()
    small_batches(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = write_table(vectors(table, id_col, vector_col, scale).withColumn("norm", F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, c: s + c * c))), "vectors")
    facts = rows.agg(F.max(F.size("x")).alias("width"), F.count("*").alias("n")).first()
    width = max(1, facts.width or 1)
    turn = rotation(rows, width)
    parts = max(1, min(tasks, -(-facts.n // CANDIDATES)))
    own = packed(rows.repartitionByRange(parts, F.desc("norm"), "id").sortWithinPartitions(F.desc("norm"), "id"), width, turn, CANDIDATES, "candidates")
    # queries of near lengths share a block, so that a block's bound is near that of each
    asked = rows.filter(F.col("id") % every == 0).groupBy("id").agg(F.min_by("x", F.struct(-F.col("norm"), "x")).alias("x"), F.max("norm").alias("norm"))
    asked = packed(asked.repartitionByRange(max(1, min(tasks, -(-facts.n // every // QUERIES))), F.desc("norm"), "id").sortWithinPartitions(F.desc("norm"), "id"), width, turn, QUERIES, "queries")
    q = asked.select(F.struct("part", "at").alias("q"), *[F.col(c).alias(f"q_{c}") for c in SIDE])

    # the longest block alone gives every query a k-th score to beat
    sizes = own.groupBy("part").agg(F.count("*").alias("blocks"), F.max("longest").alias("longest")).orderBy("part").collect()  # a row for each of the parts
    if not sizes:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("score")).limit(0)
    first = max(sizes, key=lambda r: r.longest).part
    start = write_table(compared(meeting(own.filter((F.col("part") == first) & (F.col("at") == 0)), q.withColumn("floors", F.lit(None).cast("array<double>")), [(first, 1, None)]), width, k), "start")
    kth = ranked(start, k).filter(F.col("rank") == k).select("query_id", "score")
    rest = own.filter((F.col("part") != first) | (F.col("at") != 0))
    found = write_table(start.unionByName(compared(meeting(rest, with_floors(q, kth), [(r.part, r.blocks, r.longest) for r in sizes]), width, k)), "found")
    drop_since(spark, made, found)
    return ranked(found, k)


def meeting(blocks: DataFrame, asked: DataFrame, parts: list[tuple[int, int, float | None]]) -> DataFrame:
    """The blocks of candidates and of queries that may have a score to be found, side by side.

    ``parts`` has the number of blocks and the longest vector of each part of the candidates. A block of queries goes to
    the parts whose longest vector reaches it (``reach``: the least length with which one of its queries gets to its
    score to beat), and meets the blocks there that reach it too. Blocks that can't win are not sent.
    """
    one = lambda p, n, x: F.when(F.lit(True) if x is None else F.lit(x * (1 + SLACK) + SLACK) >= F.col("reach"), F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.struct(F.lit(p).alias("part"), k.alias("at")))).otherwise(F.array().cast("array<struct<part:int,at:int>>"))
    if "reach" not in asked.columns:
        asked = asked.withColumn("reach", F.lit(float("-inf")))
    sent = asked.withColumn("to", F.explode(F.flatten(F.array(*[one(*p) for p in parts])))).select("*", "to.part", "to.at").drop("to")
    return blocks.join(sent, ["part", "at"]).filter(F.col("longest") * (1 + SLACK) + SLACK >= F.col("reach"))


def with_floors(q: DataFrame, kth: DataFrame) -> DataFrame:
    """Query blocks with the scores to beat, in the order of their ids; -inf where there is none yet; and ``reach``."""
    member = q.select("q", F.posexplode(F.arrays_zip(F.col("q_ids").alias("query_id"), F.col("q_norms").alias("norm"))).alias("at", "m")).select("q", "at", F.col("m.query_id").alias("query_id"), F.col("m.norm").alias("norm"))
    low = F.coalesce(F.col("score").cast("double"), F.lit(float("-inf")))
    reach = F.when(F.col("norm") > 0, F.col("low") / F.col("norm")).when(F.col("low") <= 0, F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    # a block's queries are a bounded group
    lists = member.join(kth, "query_id", "left").withColumn("low", low).groupBy("q").agg(F.sort_array(F.collect_list(F.struct("at", "low"))).alias("lows"), F.min(reach).alias("reach"))
    return q.join(lists.select("q", F.col("lows.low").alias("floors"), "reach"), "q")


#: The same for DuckDB.
TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""
