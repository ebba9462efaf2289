"""Queries of this subpackage's operators over the driver's tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bitpack, brown, byte_bpe, conversations, divergence, exact_dup, fingerprint, mixing, near_dup, quality, sharding, topk, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), n_shards=8)


def op2_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), mixing.Target(repeats=mixing.QUERY_REPEATS))


def op3_brown_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score_documents(table(spark, sf_dir, "documents"), held_out=2, folds=7)


def op4_bit_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    docs = table(spark, sf_dir, "documents")
    tokenizer = P.path("byte_bpe_50k.json")
    files = bitpack.write_ids(docs, tokenizer, P.PATTERN, end_id=2, vocabulary=bitpack.vocabulary_of(tokenizer))
    return bitpack.read_ids(spark, files)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return byte_bpe.encode_decode(table(spark, sf_dir, "documents"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", every=50, k=5)


def op7_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op8_probminhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc.read_back(warc.write_archive(pages, least=100), pages)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audited(conversations.damaged(table(spark, sf_dir, "conversations")))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_perfect_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dup.dedup_documents(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_label_propagation_shards": op1_label_propagation_shards,
    "op2_temperature_mixing": op2_temperature_mixing,
    "op3_brown_class_lm": op3_brown_class_lm,
    "op4_bit_packed_ids": op4_bit_packed_ids,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_iblt_fingerprints": op7_iblt_fingerprints,
    "op8_probminhash_near_dup": op8_probminhash_near_dup,
    "op9_crf_quality": op9_crf_quality,
    "op10_warc_index": op10_warc_index,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_source_divergence": op12_source_divergence,
    "op13_perfect_hash_dedup": op13_perfect_hash_dedup,
}

ORACLES: dict[str, str] = {
    "op2_temperature_mixing": mixing.MIX_SQL,
    "op6_exact_top_k": topk.TOP_SQL,
    "op10_warc_index": warc.WARC_SQL,
    "op11_conversation_repair": conversations.REPAIR_SQL,
    "op12_source_divergence": divergence.DIVERGENCE_SQL,
    "op13_perfect_hash_dedup": exact_dup.EXACT_SQL,
}
