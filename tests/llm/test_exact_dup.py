import hashlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from quire.llm import exact_dup

UPPER = {k: k + 32 for k in range(65, 91)}


def brute(rows):
    """(doc_id, keep_id, group_size, kept, text_sha256) of (doc_id, text); rows that tie are alike but for ``kept``."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(UPPER), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0), reverse=True)
        out += [(i, ids[0], len(ids), k == 0, hashlib.sha256(text.encode()).hexdigest()) for k, i in enumerate(ids)]
    return Counter(out)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = exact_dup.dedup_documents(odd_docs)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, got.collect())) == brute(rows)
    assert exact_dup.dedup_documents(no_docs).collect() == []


def test_only_ascii_letters_are_folded(spark):
    rows = [(1, "ABC É"), (2, "abc É"), (3, "abc é"), (4, "abc É "), (5, None), (6, ""), (None, "aBc É"), (None, "x"), (None, "X")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for history in (None, F.lit(True), F.lit(False), F.lit(None).cast("boolean"), F.col("doc_id") > 2):
        assert Counter(map(tuple, exact_dup.dedup_documents(df, history).collect())) == brute(rows)


def test_small_shards_and_a_hot_text(spark, monkeypatch):
    monkeypatch.setattr(exact_dup, "SHARD", 40)
    monkeypatch.setattr(exact_dup, "HEAVY", 1 / 50)
    rows = [(k, "The same text" if k % 3 == 0 else f"text {k // 2} of few") for k in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert Counter(map(tuple, exact_dup.dedup_documents(df).collect())) == brute(rows)


def test_perfect_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 5000):
        words = rng.integers(0, 2**63, (n, 4), np.uint64)
        sizes, bits = exact_dup.perfect_hash(words)
        assert sorted(exact_dup.slots(words, sizes, bits).tolist()) == list(range(n)) and bits.sum() == n
        strangers = exact_dup.slots(rng.integers(0, 2**63, (500, 4), np.uint64), sizes, bits)
        assert ((strangers >= -1) & (strangers < n)).all()
    near = np.arange(4000, dtype=np.uint64).reshape(-1, 4) * np.uint64(0)
    near[:, 3] = np.arange(1000)  # words that differ in one place alone
    sizes, bits = exact_dup.perfect_hash(near)
    assert sorted(exact_dup.slots(near, sizes, bits).tolist()) == list(range(1000))


def test_slots_hold_digests_and_winners(spark):
    rows = exact_dup.digests(spark.createDataFrame([(k, f"t{k % 50}") for k in range(200)], "doc_id long, text string"))
    index = exact_dup.build_index(rows, 3).collect()
    assert {r.shard for r in index} == {0, 1, 2}
    for r in index:
        digests = [bytes(r.digests[k : k + 32]) for k in range(0, len(r.digests), 32)]
        bits = np.unpackbits(np.frombuffer(bytes(r.bits), np.uint8), count=sum(r.levels)).astype(bool)
        words = np.frombuffer(bytes(r.digests), "<u8").reshape(-1, 4)
        assert exact_dup.slots(words, r.levels, bits).tolist() == list(range(len(digests)))
        for d, w, n in zip(digests, r.winners, r.sizes, strict=True):
            k = next(k for k in range(50) if hashlib.sha256(f"t{k}".encode()).digest() == d)
            assert (w.doc_id, n) == (150 + k, 4)


def test_later_batches_against_an_index(spark):
    """Documents of a later batch that the index holds, or that repeat among themselves, go; rows of the index are not
    given again."""
    old = exact_dup.digests(spark.createDataFrame([(1, "a"), (9, "b"), (3, "c")], "doc_id long, text string"))
    new = exact_dup.digests(spark.createDataFrame([(5, "A"), (6, "B"), (7, "new"), (8, "NEW")], "doc_id long, text string"), 1)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dup.dedup(new, exact_dup.build_index(old, 2), 2).collect()}
    assert got == {5: (5, 2, True), 6: (9, 2, False), 7: (8, 2, False), 8: (8, 2, True)}
