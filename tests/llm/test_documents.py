import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from quire.llm import fingerprint, mixing, near_dup, sharding

from .conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({k: k + 32 for k in range(65, 91)})


# shards


def test_shards_of_odd_rows(spark, odd_docs, no_docs):
    import zlib

    rows = sharding.shard_documents(odd_docs).collect()
    docs = odd_docs.collect()
    want = [(r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()) + (0 if r.text is None else 0) + 1, zlib.crc32((r.text or "").encode())) for r in docs]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == sorted(want)
    for s in range(8):
        own = sorted(r.slot for r in rows if r.shard == s)
        assert own == list(range(len(own)))
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    assert sharding.shard_documents(no_docs).collect() == []


def test_shards_are_even_and_keep_copies(spark):
    rng = random.Random(4)
    texts = [prose(rng, rng.randint(1, 200)) for _ in range(900)]
    rows = [(k, texts[k % 900] if k >= 300 else texts[k % 60]) for k in range(1200)]
    out = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sizes = Counter()
    for r in out:
        sizes[r.shard] += r.size
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) < 0.01 * sum(sizes.values()) / 8
    groups = defaultdict(set)
    of = dict(rows)
    for r in out:
        groups[of[r.doc_id]].add(r.shard)
    assert sum(len(g) > 1 for g in groups.values()) <= 2


def test_one_group_larger_than_a_shard(spark):
    rows = [(k, "the same text" if k % 3 == 0 else f"text {k} " * (k % 9)) for k in range(900)]
    out = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sizes = Counter()
    for r in out:
        sizes[r.shard] += r.size
    assert max(sizes.values()) - min(sizes.values()) < 0.02 * sum(sizes.values()) / 8


def test_general_links_cut_few(spark):
    """Two links a document, in rings of neighbours."""
    v = spark.createDataFrame([(k, 10) for k in range(400)], "v long, size long")
    m = spark.createDataFrame([(k, g) for k in range(400) for g in (k // 10, 1000 + k // 20)], "v long, link long")
    shard = {r.v: r.shard for r in sharding.shard(v, m, 4).collect()}
    assert len(shard) == 400
    sizes = Counter(shard.values())
    assert max(sizes.values()) - min(sizes.values()) <= 2
    whole = sum(len({shard[k] for k in range(a, a + 10)}) == 1 for a in range(0, 400, 10))
    assert whole >= 20  # of 40; none by chance


def test_even_out():
    loads = [100, 10]
    moves = sharding.even_out(loads, {0: [(30, 1), (44, 2), (80, 3)]}, 0)
    assert moves == {(0, 2): 1} and loads == [56, 54]


# mixing


def plan_model(counts, repeats):
    import math

    lo, hi = 0.0, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        r = [math.log(c) * (mid - 1) for c in counts.values()]
        lo, hi = (lo, mid) if max(r) - min(r) <= math.log(repeats) else (mid, hi)
    return hi


def test_mixture_covers_and_repeats(spark):
    rng = random.Random(6)
    rows = [(k, prose(rng, rng.randint(1, 40)), "big" if k % 4 else f"s{k % 3}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs, mixing.Target(repeats=3.0)).collect()
    tokens = Counter()
    for _, t, s in rows:
        tokens[s] += len(t.split()) + 1
    size = {k: len(t.split()) + 1 for k, t, _ in rows}
    assert {r.doc_id for r in out} == set(size)  # every document at least once
    assert len({(r.doc_id, r.epoch) for r in out}) == len(out)
    alpha = plan_model(tokens, 3.0)
    assert all(abs(r.exponent - alpha) < 1e-6 for r in out)
    got = Counter()
    for r in out:
        got[r.source] += size[r.doc_id]
    weight = {s: t**alpha for s, t in tokens.items()}
    total = sum(weight.values())
    budget = max(tokens[s] / (weight[s] / total) for s in tokens)
    for s in tokens:
        quota = max(tokens[s], round(weight[s] / total * budget))
        assert 0 <= quota - got[s] <= 45  # the head stops at a document
    blocks = Counter(r.block for r in out)
    assert sorted(blocks) == list(range(len(blocks)))
    heads = {r.source: r.weight for r in out}
    assert abs(sum(heads.values()) - 1) < 1e-6


@pytest.mark.parametrize("target", [mixing.Target(repeats=None, entropy=1.2, budget=20_000), mixing.Target(repeats=1.5, budget=30_000)])
def test_mixture_targets(spark, target):
    import math

    rows = [(k, "w " * 20, "a" if k % 8 else f"s{k % 3}") for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs, target).collect()
    weights = {r.source: r.weight for r in out}
    if target.entropy:
        assert abs(-sum(w * math.log2(w) for w in weights.values()) - 1.2) < 1e-5
    used = Counter(r.source for r in out)
    have = Counter(s for _, _, s in rows)
    assert abs(sum(used.values()) * 21 - target.budget) <= 21 * 4
    if target.repeats:
        assert all(used[s] <= 1.5 * have[s] + 1 for s in used)


def test_mixing_of_odd_rows(spark, odd_docs, no_docs):
    out = mixing.mix(odd_docs).collect()
    assert {r.doc_id for r in out} == {r.doc_id for r in odd_docs.select("doc_id").collect()}
    assert mixing.mix(no_docs).collect() == []
    rows = mixing.mixture(odd_docs)
    assert rows.columns == odd_docs.columns and rows.count() == len(out)


def test_many_sources_are_salted(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SENT", 1)
    docs = spark.createDataFrame([(k, "a b c", f"s{k % 5}") for k in range(60)], "doc_id long, text string, source string")
    salted = sorted(map(tuple, mixing.mix(docs).collect()))
    monkeypatch.undo()
    assert salted == sorted(map(tuple, mixing.mix(docs).collect()))


# fingerprints


def edited_model(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    return {k: t[: len(t) - len(t) // 2] + rows[(i + 1) % len(rows)][1][: len(t) // 2] for i, (k, t) in enumerate(rows)}


def test_fingerprints(spark, monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(fingerprint, "BUCKET_CHARS", 3000)
    rows = [(k * 7 + (10**12 if k > 50 else 0), "\n".join(prose(rng, rng.randint(0, 90)) for _ in range(rng.randint(1, 12))) + "é漢"[: k % 3]) for k in range(80)]
    rows += [(1, rows[4][1]), (2, "")]
    out = {r.doc_id: r for r in fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    edited, texts = edited_model(rows), dict(rows)
    order = sorted(texts)

    def pieces(t):
        marked = " ".join(w + "\n" * (xxhash.xxh64(w.encode(), seed=42).intdigest() % fingerprint.CUT == 0) for w in t.split(" "))
        return {p.strip(" ") for p in marked.split("\n")} - {""}

    def like(a, b):
        a, b = pieces(a), pieces(b)
        return 1.0 if not a | b else 1 - len(a ^ b) / (len(a) + len(b))

    for i, k in enumerate(order):
        r = out[k]
        assert (r.n_chars, r.edited_sha256) == (len(texts[k]), hashlib.sha256(edited[k].encode()).hexdigest())
        assert abs(r.near_edited - like(texts[k], edited[k])) < 1e-9
        assert abs(r.near_next - like(texts[k], texts[order[(i + 1) % len(order)]])) < 1e-9
    assert out[1].fingerprint == out[rows[4][0]].fingerprint != out[2].fingerprint


def test_peeling_recovers_small_differences(spark):
    both = spark.createDataFrame([(list(range(500, 500 + n)), list(range(500 + d, 500 + n))) for n, d in ((20, 0), (20, 2), (300, 4), (3, 3))], "a array<long>, b array<long>")
    mixed = both.select(F.transform("a", lambda x: F.xxhash64(x)).alias("a"), F.transform("b", lambda x: F.xxhash64(x)).alias("b"))
    small = fingerprint.peeled(fingerprint.subtract(fingerprint.sketch(F.col("a"), 4), fingerprint.sketch(F.col("b"), 4)), 4)
    want = [set(r.a) ^ set(r.b) for r in mixed.collect()]
    assert [len(x) for x in want] == [0, 2, 4, 3] and [set(r[0]) for r in mixed.select(small).collect()] == want
    found = [r[0] for r in mixed.select(fingerprint.differing(F.col("a"), F.col("b"))).collect()]
    assert [set(x) for x in found] == want and all(len(set(x)) == len(x) for x in found)
    apart = fingerprint.peeled(fingerprint.subtract(fingerprint.sketch(F.col("a"), 4), fingerprint.sketch(F.transform("a", lambda x: x + 1), 4)), 4)
    assert [r[0] for r in mixed.select(apart).collect()][2] is None  # too many for a small sketch


def test_a_word_put_in_moves_no_other_cut(spark):
    rng = random.Random(15)
    words = [f"w{rng.randrange(10**5)}" for _ in range(400)]
    rows = [(" ".join(words), " ".join([*words[:k], "inserted", *words[k:]])) for k in (0, 1, 200, 399, 400)]
    both = spark.createDataFrame(rows, "a string, b string").select(*[fingerprint.paragraphs(F.col(c)).alias(c) for c in "ab"])
    near = fingerprint.likeness(F.col("a"), F.col("b"), fingerprint.sketch(F.col("a"), 4), fingerprint.sketch(F.col("b"), 4))
    assert all(0.9 < r[0] < 1 for r in both.select(near).collect())


def test_null_ids_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "BUCKET_CHARS", 500)
    rows = [(None, f"text {k} " * 9) for k in range(40)] + [(k, f"other {k} " * (k % 7 * 30)) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    base = docs.withColumn("n_chars", F.length("text").cast("long")).withColumn("tie", F.xxhash64("text"))
    out = fingerprint.with_next(base, ["doc_id", "text"]).collect()
    order = sorted(out, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.tie))
    assert len(out) == 100 and all(a.next.text == b.text and a.next.doc_id == b.doc_id for a, b in zip(order, order[1:] + order[:1], strict=True))


def test_fingerprints_of_odd_rows(spark, odd_docs, no_docs):
    rows = fingerprint.fingerprints(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert fingerprint.fingerprints(no_docs).collect() == []
    alone = fingerprint.fingerprints(spark.createDataFrame([(3, "ab c")], "doc_id long, text string")).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and alone.near_next == 1.0


# near-duplicates


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def classes(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) > 0:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    heads = {}
    for i, (k, _) in enumerate(rows):
        heads.setdefault(find(i), []).append(k)
    return {rows[i][0]: min(heads[find(i)]) for i in range(len(rows))}


def copies(rng, n, words=120):
    base = prose(rng, words).split()
    for _ in range(n):
        out = list(base)
        for _ in range(rng.randint(0, 5)):
            out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
        yield " ".join(out)


def test_near_duplicates_equal_all_pairs(spark, monkeypatch):
    """Groups whose members are linked through others only, a shared passage, and blocks of few nodes."""
    rng = random.Random(12)
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    passage = prose(rng, 60)
    texts = [t for n in (60, 9, 2, 2) for t in copies(rng, n)] + [f"{passage} {prose(rng, 60)}" for _ in range(40)] + [prose(rng, 50) for _ in range(30)]
    texts += [texts[0], texts[0].upper().replace("É", "é"), "", " ", "one two", "ONE  two"]
    rows = [(k, t) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == classes(sorted(rows))


def test_components(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(200, 260)] + [(rng.randrange(100), rng.randrange(100)) for _ in range(60)] + [(500, k) for k in range(501, 560)] + [(7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in near_dup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert near_dup.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_registers_estimate_the_weighted_likeness():
    rng = random.Random(1)
    base = prose(rng, 400).split()
    other = [w if k % 9 else f"y{k}" for k, w in enumerate(base)]
    h, of, times = near_dup.shingles(pa.array([" ".join(base), " ".join(other)]))
    own = near_dup.registers(h, of, 1 + np.log(times), 2)
    a, b = shingles(" ".join(base)), shingles(" ".join(other))
    assert abs((own[0] == own[1]).mean() - len(a & b) / len(a | b)) < 0.13


def test_near_duplicates_of_odd_rows(spark, odd_docs, no_docs):
    rows = near_dup.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    of = {r.doc_id: r.class_id for r in rows}
    assert of[100] == of[101] == of[102] == 100 and of[105] == of[106] == of[3] == 3 and of[103] == 103
    assert near_dup.near_duplicates(no_docs).collect() == [] and near_dup.keep_one(no_docs).collect() == []
    kept = near_dup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert set(ids) - {None} == {c for c in of.values() if c is not None} and ids[3] == 1 and ids[5] in (1, 2)


def test_pairs_that_agree_in_an_earlier_band_by_chance(spark):
    """Two nodes that share the bucket of a later band only."""
    members = spark.createDataFrame([(77, 9, k, k, 1) for k in (1, 2)], "bucket long, band int, node long, component long, weight long")
    sets = spark.createDataFrame([(k, np.arange(100, dtype=np.uint32).tobytes()) for k in (1, 2)], "node long, shingles binary")
    assert [tuple(r) for r in near_dup.remaining(members, sets).collect()] == [(1, 2)]


def test_near_duplicates_that_differ_in_repeats(spark):
    """Copies of which one repeats a passage 1, 20 or 1,000 times: their sets are alike, their weights are not."""
    rows = []
    for k, n in enumerate((1, 20, 1000) * 4):
        plain, passage = ([f"{c}{k}x{j}" for j in range(m)] for c, m in (("p", 74), ("r", 30)))
        for c in "ab":
            end = [f"{c}{k}x{j}" for j in range(3)]
            rows.append((len(rows), " ".join(plain + passage * (n if c == "a" else 1) + end)))
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: k // 2 * 2 for k, _ in rows} == classes(rows)


def test_near_duplicates_of_texts_with_one_set(spark):
    """Texts of one set in which one of two passages repeats 2 and the other 300 times, and near copies of one of them."""
    rows = []
    for k in range(8):
        p, q = ([f"{c}{k}x{j}" for j in range(50)] for c in "pq")
        rows += [(len(rows) + x, " ".join(p * n + q * m + [f"{c}{k}x{j}" for j in range(3)])) for x, (n, m, c) in enumerate(((2, 300, "a"), (300, 2, "a"), (2, 300, "b")))]
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: k // 3 * 3 for k, _ in rows} == classes(rows)


def test_near_copies_without_ids(spark):
    rng = random.Random(13)
    base = prose(rng, 200)
    groups = [[f"{base} {k}{c}" for c in "abc"] if k < 1 else [f"{prose(rng, 200)} x{k}"] * 2 for k in range(3)]
    rows = [(None, t) for g in groups for t in g] + [(7, f"{groups[1][0]} end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(r.class_id for r in near_dup.near_duplicates(docs).collect())
    assert got == {None: 5, 7: 3}
    kept = sorted(r.text for r in near_dup.keep_one(docs).collect())
    assert len(kept) == 3 and kept.count(f"{groups[1][0]} end") == 1 and kept.count(groups[2][0]) == 1


def test_the_last_comparison_equals_all_pairs(spark, monkeypatch):
    """One bucket of nodes that are their own components, in blocks of a few."""
    monkeypatch.setattr(near_dup, "BLOCK", 5)
    rng = random.Random(8)
    sets = {k: set(rng.sample(range(1000 * (k % 3), 1000 * (k % 3) + 24), rng.randint(18, 24))) | ({9000 + k} if k % 2 else set()) for k in range(40)}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    members = spark.createDataFrame([(77, k, k, 1) for k in sets], "bucket long, node long, component long, weight long")
    given = spark.createDataFrame([(k, np.array(sorted(x), np.uint32).tobytes()) for k, x in sets.items()], "node long, shingles binary")
    assert want and {tuple(r) for r in near_dup.remaining(members, given).collect()} == want


def sets_table(spark, sets):
    return spark.createDataFrame([(k, np.array(sorted(x), np.uint32).tobytes()) for k, x in sets.items()], "node long, shingles binary")


def test_alike_sets_share_a_leading_shingle():
    rng = random.Random(21)
    alike, every = 0, [np.random.default_rng(k).integers(0, 4, near_dup.SLOTS) for k in range(5)]
    for _ in range(3000):
        x = set(rng.sample(range(2000), rng.randint(1, 60)))
        y = (x - set(rng.sample(sorted(x), rng.randint(0, len(x) // 5)))) | set(rng.sample(range(2000), rng.randint(0, len(x) // 5)))
        if not y or len(x & y) < 0.8 * len(x | y):
            continue
        alike += 1
        counts = rng.choice(every)
        first = [set(near_dup.leading(np.array(sorted(s), np.uint32), counts).tolist()) for s in (x, y)]
        assert first[0] & first[1] and all(len(f) <= len(s) // 5 + 1 for f, s in zip(first, (x, y), strict=True))
    assert alike > 1000


def test_large_buckets_dealt_out_equal_all_pairs(spark, monkeypatch):
    """Two large buckets and a small one; sets of few, of many and of the same shingles; some in one component."""
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    rng = random.Random(18)
    sets = {k: set(rng.sample(range(1000 * (k % 3), 1000 * (k % 3) + 24), rng.randint(18, 24))) | ({9000 + k} if k % 2 else set()) for k in range(60)}
    sets |= {60: {1}, 61: {1, 2}, 62: {1}, 63: set(range(500)), 64: set(range(480))}
    buckets = {77: range(65), 78: range(30, 65), 79: (0, 3, 6)}
    component = {k: 3 if k in (3, 9, 12) else k for k in sets}
    want = {(a, b) for a in sets for b in sets if a < b and component[a] != component[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    members = spark.createDataFrame([(b, k, component[k], 1) for b, own in buckets.items() for k in own], "bucket long, node long, component long, weight long")
    given = sets_table(spark, sets)
    assert (60, 62) in want and (63, 64) in want and {tuple(r) for r in near_dup.remaining(near_dup.regrouped(members, given), given).collect()} == want


def test_many_unlike_variants_of_a_template(spark):
    """One bucket of 20,000 sets that share 70 of 100 shingles, a hundred near pairs among them: every pair is found, and
    those compared are a small number for each node."""
    n = 20_000
    sets = {k: set(range(70)) | set(range(1000 + 30 * k, 1030 + 30 * k)) for k in range(n)}
    for k in range(0, 200, 2):
        sets[k + 1] = (sets[k] - {1000 + 30 * k}) | {900_000_000 + k}
    members = spark.createDataFrame([(7, k, k, 1) for k in range(n)], "bucket long, node long, component long, weight long")
    given = sets_table(spark, sets)
    groups = near_dup.regrouped(members, given)
    assert near_dup.pairs_left(groups) < 20 * n  # of 200,000,000
    assert {tuple(r) for r in near_dup.remaining(groups, given).collect()} == {(k, k + 1) for k in range(0, 200, 2)}


def test_ids_too_many_to_send(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(k, t) for k, t in enumerate(list(copies(rng, 5)) + [prose(rng, 30) for _ in range(5)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, near_dup.keep_one(docs).collect()))
    monkeypatch.setattr(near_dup, "MOST_SENT", 0)
    assert sorted(map(tuple, near_dup.keep_one(docs).collect())) == want


def test_columns_of_the_same_names_as_those_at_work(spark):
    rows = [(1, "a b c d e f", 7, 8), (2, "a b c d e f", 9, 10), (1, "a b c d e f", 7, 8), (3, "other words are in this text", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __tie long, __n long")
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [rows[0], rows[3]]


def links(texts):
    """All pairs of different sets with a Jaccard of 0.8 or more, through an index of the shingles."""
    sets = {}
    for t in texts:
        sets.setdefault(shingles(t), len(sets))
    index = defaultdict(list)
    for s, k in sets.items():
        for x in s:
            index[x].append(k)
    of = {k: s for s, k in sets.items()}
    found = set()
    for k, s in of.items():
        for j, n in Counter(j for x in s for j in index[x] if j < k).items():
            if n >= 0.8 * (len(s) + len(of[j]) - n):
                found.add((j, k))
    return sets, found


@pytest.mark.parametrize("settings", [{}, {"MOST_STARS": 2, "FEW_PAIRS": 0, "BLOCK": 32}])
def test_every_link_of_a_table(spark, monkeypatch, settings):
    """All near copies of the documents at sf0.01, with the query's settings, and with a further round of stars and
    smaller blocks."""
    for name, value in settings.items():
        monkeypatch.setattr(near_dup, name, value)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = sorted(map(tuple, docs.collect()))
    of = {r.doc_id: r.class_id for r in near_dup.near_duplicates(docs).collect()}
    sets, found = links([t for _, t in rows])
    first = {}
    for k, t in rows:
        first.setdefault(sets[shingles(t)], k)
    assert found and all(of[first[a]] == of[first[b]] for a, b in found)
    parent = {k: k for k in of}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in [(first[a], first[b]) for a, b in found] + [(first[sets[shingles(t)]], k) for k, t in rows]:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    assert of == {k: find(k) for k in of}
