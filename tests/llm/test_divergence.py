import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import divergence

UPPER = {k: k + 32 for k in range(65, 91)}
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, terms=200):
    """(lang, source, part, item, value, rank) of (text, lang, source), with dense counts."""
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(UPPER))) for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in df.items() if n >= 3)
        counts = defaultdict(Counter)
        for _, source, words in own:
            counts[source].update(w for w in words if df[w] >= 3)

        def shares(count):
            n = sum(count.values()) + len(kept)
            return [1 + 1_000_000_000 * (count[t] + 1) // n for t in kept]

        p = {source: shares(counts[source]) for source in {d[1] for d in own}}
        q = shares(sum(counts.values(), Counter()))
        for source in p:
            pairs = [(-sum((x - y) ** 2 // y for x, y in zip(p[source], p[o], strict=True)), o.encode()) for o in p if o != source]
            best = [(-((x - y) ** 2 // y), t.encode()) for t, x, y in zip(kept, p[source], q, strict=True) if counts[source][t] and x > y]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(best)[:terms])):
                out |= {(lang, source, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(found)}
    return out


def check(df):
    got = [tuple(r) for r in divergence.audit(df).collect()]
    want = brute([(r.text, r.lang, r.source) for r in df.select("text", "lang", "source").collect()])
    assert len(got) == len(set(got)) and set(got) == want
    return got


def test_odd_rows(spark, odd_docs, no_docs):
    assert divergence.audit(odd_docs).columns == ["lang", "source", "part", "item", "value", "rank"]
    check(odd_docs)
    assert divergence.audit(no_docs).collect() == []


def test_terms_that_touch_repeat_or_lack(spark):
    rows = [("aa aa  AA-aa", "en", "s1"), ("aa b\x00b É", "en", "s2"), ("É aa", "en", "s3"), ("é aa É", "en", None), ("b É漢 漢", "en", "s1"), ("", "en", "empty"), ("x", "de", "s1"), ("y", "de", "s2"), (None, "fr", "s1"), ("zz zz zz", "es", "one")]
    rows += [("zz", "es", "one")] * 3 + [("aa " * 4000, "en", "s9"), ("[a]b`c{d}e~f", "en", "s9")] * 2
    got = check(spark.createDataFrame(rows, "text string, lang string, source string"))
    assert ("de", "s1", "pair", "s2", 0, 1) in got  # no term is kept
    assert not [r for r in got if r[0] == "fr"] and [r for r in got if r[:3] == ("en", "empty", "pair")]


@pytest.mark.parametrize("dense", [3, 1024])
def test_many_sources_in_small_blocks_and_buckets(spark, monkeypatch, dense):
    monkeypatch.setattr(divergence, "DENSE", dense)
    monkeypatch.setattr(divergence, "BUCKET", 2000)
    monkeypatch.setattr(divergence, "BLOCK", 2)
    monkeypatch.setattr(divergence, "HELD", 50)
    monkeypatch.setattr(divergence, "CHUNK", 100)
    rows = [(" ".join(f"w{'abcdefghijklmnopqrstuvwxyz'[(k * j) % 26]}{'xyz'[j % 3]}" for j in range(k % 17)), "en", f"s{k % 11:02d}") for k in range(300)]
    check(spark.createDataFrame(rows, "text string, lang string, source string").repartition(4))


def test_blocks_of_a_file(spark, tmp_path):
    docs = spark.createDataFrame([(f"t{k}" if k % 50 else "long " * 10_000, "en", "s") for k in range(3000)], "text string, lang string, source string")
    docs.coalesce(1).write.parquet(str(tmp_path / "docs"))
    rows = divergence.blocked(spark.read.parquet(str(tmp_path / "docs")))
    sizes = rows.groupBy("block").agg(F.sum(F.length("text")).alias("n"), F.count("*").alias("rows")).collect()
    assert max(r.n for r in sizes) < 2 << (divergence.BLOCK + 14) and 3 < len(sizes) < 40
    again = divergence.blocked(spark.read.parquet(str(tmp_path / "docs")))
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, again.collect()))


def test_shares_pass_64_bits(spark):
    big = 9_000_000_000_000
    row = spark.createDataFrame([(big, 3 * big, 7)], "n long, size long, v long").select(divergence.share("n").alias("p")).first()
    assert row.p == 1 + 1_000_000_000 * (big + 1) // (3 * big + 7)
    n = np.array([big, 5])
    assert divergence.shares(n, np.array([3 * big + 7, 9])).tolist() == [row.p, 1 + 6 * 10**9 // 9]
    far = spark.createDataFrame([(1_000_000_001, 3)], "p long, q long").select(divergence.value("p", "q").alias("f")).first()
    assert far.f == (1_000_000_001 - 3) ** 2 // 3
