import hashlib
import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest

from quire.llm import topk, warc


def brute(rows, k=5, every=50):
    ok = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in ok), default=0)
    x = np.array([v + [0] * (width - len(v)) for _, v in ok], np.int64).reshape(len(ok), width)
    ids = np.array([i for i, _ in ok])
    out = []
    for q in sorted({i for i in ids.tolist() if i % every == 0}):
        s = x @ x[ids.tolist().index(q)]
        order = sorted((-int(s[j]), int(ids[j])) for j in range(len(ids)) if ids[j] != q)[:k]
        out += [(q, r + 1, i, -n) for r, (n, i) in enumerate(order)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_top_k_equals_brute_force(spark, monkeypatch, small):
    rng = np.random.default_rng(3)
    if small:
        monkeypatch.setattr(topk, "CANDIDATES", 64)
        monkeypatch.setattr(topk, "QUERIES", 4)
    x = rng.normal(size=(700, 12)) * rng.gamma(1, 1, (700, 1))
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    rows += [(1000 + k, x[3].tolist()) for k in range(90)]  # ties
    rows += [(2000, None), (2001, [None] * 12), (2002, [math.nan] * 12), (2003, [math.inf] * 12), (None, x[0].tolist()), (2050, x[1].tolist()[:5]), (2100, [0.0] * 12), (2150, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(df, "vec_id", "embedding").collect())) == brute(rows)


def test_blocks_that_cannot_win_are_not_sent(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 32)
    monkeypatch.setattr(topk, "QUERIES", 8)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1200, 6)) * np.exp(rng.normal(size=(1200, 1)))
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    sent = []
    meeting = topk.meeting

    def counted(blocks, asked, parts):
        out = meeting(blocks, asked, parts)
        sent.append((out.count(), blocks.count() * asked.count()))
        return out

    monkeypatch.setattr(topk, "meeting", counted)
    assert sorted(map(tuple, topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding").collect())) == brute(rows)
    assert sent[0][0] == sent[0][1] and 0 < sent[1][0] < sent[1][1] / 2


def test_top_k_of_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], "q"), (0, [1.0, 2.0], "q"), (7, [0.5, 0.5], "x"), (7, [0.5, 0.5], "x"), (9, [-1.0, 0.0], "n")], "vec_id long, embedding array<double>, score string")
    assert [tuple(r) for r in topk.top_k(df, "vec_id", "embedding").orderBy("rank").collect()] == [(0, 1, 7, 98304), (0, 2, 7, 98304), (0, 3, 9, -65536)]
    assert topk.top_k(df.limit(0), "vec_id", "embedding").collect() == []
    assert topk.top_k(df.filter("vec_id = 0").distinct(), "vec_id", "embedding").collect() == []


PAGES = [
    (5, "http://WWW.a.example.com:80/x?y=1#z", "p" * 200), (3, "https://b.example.com/", "p" * 200), (9, "http://b.example.com", "p" * 200),
    (1, "http://c.org/ü\n", "short"), (2, "http://c.org/", "short"), (4, None, None), (6, "", ""), (7, "not a url", "é" * 60), (8, "http://[bad", "é" * 60),
    (None, "http://d.org/", "p" * 200), (3, "https://b.example.com/", "p" * 200), (10, "http://c.org/", "x\r\n\r\ny" * 50),
]


def test_archive(spark, monkeypatch):
    monkeypatch.setattr(warc, "LINES", 3)
    pages = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, digest int")
    archive = warc.write_archive(pages)
    got = sorted((r.page_id is None, r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_back(archive, pages).collect())
    want = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        same = [j for j, _, h in PAGES if (h or "").encode() == data and j is not None]
        again = len(data) >= 100 and i is not None and i > min(same)
        want.append((i is None, i or 0, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", min(same) if again else None))
    assert got == sorted(want)
    files = archive.files.collect()
    assert sum(r.lines for r in files) == len(PAGES) and all(r.blocks == -(-r.lines // 3) for r in files)
    found = list(archive.lookup("https://www.b.example.com/"))
    assert sorted((h["X-Page-ID"], h["WARC-Type"], len(p)) for h, p in found) == [("3", "response", 200), ("3", "response", 200), ("9", "revisit", 0)]
    assert len(list(archive.lookup("http://c.org/"))) == 2 and list(archive.lookup("http://nowhere.example/")) == []
    empty = warc.write_archive(pages.limit(0))
    assert warc.read_back(empty, pages).collect() == [] and list(empty.lookup("http://c.org/")) == []


def test_a_lookup_bisects(spark, monkeypatch):
    """Blocks of two lines; captures of one URL fill several of them. A search reads as many entries as it halves."""
    monkeypatch.setattr(warc, "LINES", 2)
    rows = [(k, f"http://h{k % 97:02d}.org/{k % 5}", f"page {k}") for k in range(900)] + [(1000 + k, "http://same.org/", "x" * 120) for k in range(41)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archive = warc.write_archive(pages)
    assert sorted(r.page_id for r in warc.read_back(archive, pages).collect()) == sorted(r[0] for r in rows)
    assert [int(h["X-Page-ID"]) for h, _ in archive.lookup("http://same.org/")] == list(range(1000, 1041))
    want = Counter(warc.url_key(u) for _, u, _ in rows)
    blocks = max(r.blocks for r in archive.files.collect())
    for key, n in list(want.items())[::40]:
        index = archive.index()
        lines = list(itertools.takewhile(lambda x, key=key: x["urlkey"] == key, index.since((key, False, 0))))
        assert len(lines) == n and index.reads <= 2 * math.ceil(math.log2(blocks)) + 3 * (n // 2 + 3)


def test_url_keys():
    keys = {"http://WWW.a.example.com:80/x?y=1#z": "com,example,a)/x?y=1", "https://a.b:8080": "b,a:8080)/", None: "", "": ""}
    assert {u: warc.url_key(u) for u in keys} == keys
    rng = random.Random(1)
    assert all(isinstance(warc.url_key("".join(chr(rng.randint(32, 300)) for _ in range(20))), str) for _ in range(300))


def test_a_damaged_payload_is_seen(spark, tmp_path):
    raw = warc.record(1, "http://a/", b"payload", "0" * 64, None)
    headers, _, payload = warc.parse(raw)
    assert payload == b"payload" and headers["WARC-Payload-Digest"].endswith("0" * 64)
