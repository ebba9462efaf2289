"""A corpus pipeline: drop poor documents, keep one of each group of near-duplicates, mix the sources, encode.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's
docs. All stages but the last return the columns of ``documents``, and whatever other columns their docs have, untouched.
A null text is the empty text to every stage, and an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import byte_bpe, mixing, near_dup, quality
from quire.llm._common import new_path

#: Most repeats of a source in the mixture.
REPEATS = 1.5


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier, learnt from the labels, finds good. Repeated rows stay or go together; ids, null or
    not, have no part in the score."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that of the smallest doc_id (nulls last) and text hash; of repeated rows
    one stays."""
    return near_dup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of smaller sources more often, in the order of their permutations. A null source is
    the source ''; repeated rows are documents of their own."""
    return mixing.mixture(docs, mixing.Target(repeats=REPEATS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row of the mixture, with the digests of the ids and of the bytes decoded from them. Repeated rows give
    repeated rows; other columns do not pass."""
    import public_tokenizers as P

    return byte_bpe.encode_decode(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, with_ids=True)


STAGES = [("quality", drop_poor), ("near_dedup", drop_copies), ("mixing", mix_sources), ("byte_bpe", encode)]

#: The classifier, the near-duplicates and the encoding can't be said in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
