import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quire.llm import brown, quality
from quire.llm._text import raw, words

from .conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({k: k + 32 for k in range(65, 91)})


def tokens(text):
    return WORD.findall((text or "").translate(LOWER)) + ["\0end"]


def test_words_of_bytes(monkeypatch):
    texts = ["a  B\tç ", "", " ", "x" * 50, "one\x0btwo\x1cthree", "wort " * 40]
    for chunk in (1 << 21, 16):
        monkeypatch.setattr("quire.llm._text.CHUNK", chunk)
        h, of, at = words(*raw(pa.array(texts)))
        want = [(k, w) for k, t in enumerate(texts) for w in WORD.findall(t.translate(LOWER))]
        assert of.tolist() == [k for k, _ in want]
        assert len({(x, w) for x, (_, w) in zip(h.tolist(), want, strict=True)}) == len(set(h.tolist())) == len({w for _, w in want})


def test_brown_of_odd_rows(spark, odd_docs, no_docs):
    rows = brown.score_documents(odd_docs).collect()
    docs = odd_docs.collect()
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    counts = Counter(t for r in docs if not held(r.doc_id) for t in tokens(r.text))
    n, v = sum(counts.values()), len(counts)
    want = []
    for r in docs:
        t = tokens(r.text)
        want.append((r.doc_id is None, r.doc_id or 0, held(r.doc_id), len(t), sum(counts[x] > 0 for x in t), n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in t), 6)))
    got = [(r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows]
    assert sorted(got) == sorted(want)
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert brown.score_documents(no_docs).collect() == []


def test_brown_learns_classes(spark, monkeypatch):
    """Words of two kinds alternate; the classes tell the next kind, the unigrams do not. Few words are clustered and
    counted, so that the join of the others is in play too."""
    rng = random.Random(2)
    monkeypatch.setattr(brown, "COUNTED", 620)
    monkeypatch.setattr(brown, "CLUSTERED", 600)
    kinds = [[f"a{k}" for k in range(320)], [f"b{k}" for k in range(320)]]
    docs = spark.createDataFrame([(k, " ".join(rng.choice(kinds[j % 2]) for j in range(160))) for k in range(150)], "doc_id long, text string")
    rows = brown.score_documents(docs).filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) + 0.15 * sum(r.n_tokens for r in rows)
    counts = Counter(t for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 7 != 2 for t in tokens(r.text))
    texts = {r.doc_id: r.text for r in docs.collect()}
    n, v = sum(counts.values()), len(counts)
    assert all(abs(r.base_score - sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens(texts[r.doc_id]))) < 1e-6 for r in rows)


def model_of(rare, m):
    """{word's key: (count, class)} of all training words."""
    out = {int(w): (int(n), int(c)) for w, n, c, u in zip(m.words.words, m.words.counts, m.word_classes, m.words.unit, strict=True) if u >= 0}
    return out | {r.word: (r.n, r["class"]) for r in rare.collect()}


@pytest.mark.parametrize("counted", [40, 10**6])
def test_brown_scores_equal_brute_force(spark, monkeypatch, counted):
    """Every term from counts in dictionaries, for words that the exchange has, words that are sent, and others."""
    monkeypatch.setattr(brown, "CLUSTERED", 20)
    monkeypatch.setattr(brown, "COUNTED", counted)
    rng = random.Random(5)
    texts = {k: prose(rng, rng.randint(0, 60)) + f" once{k} " + ("newword" if k == 4 else "") for k in range(60)}
    docs = spark.createDataFrame([(k, t, k % 6 != 4) for k, t in texts.items()], "doc_id long, text string, learnt boolean")
    scored, total, m, rare = brown.learnt_and_scored(docs)
    of = model_of(rare, m)

    def keys(t):
        h, s, _ = brown.tokens(pa.array([t]))
        return [(int(k), int(x)) for k, x in zip(brown.key_of(h, s), s, strict=True)]

    units = {int(w): int(u) for w, u in zip(m.words.words, m.words.unit, strict=True) if u >= 0}
    history = lambda k, s: int(m.classes[units[k]]) if k in units else brown.CLASSES + s
    counts = Counter(k for i, t in texts.items() if i % 6 != 4 for k, _ in keys(t))
    assert total == sum(counts.values()) and {k: n for k, (n, _) in of.items()} == counts and len(units) <= 20 < len(of)
    after, mass = Counter(), Counter()
    for i, t in texts.items():
        if i % 6 != 4:
            h = brown.START
            for k, s in keys(t):
                after[h, of[k][1]] += 1
                h = history(k, s)
    for n, c in of.values():
        mass[c] += n + 1
    v, once = len(counts), sum(n == 1 for n in counts.values())
    base = 1 / (total + v + 1)

    def share(h, c):
        row = {x: after[h, x] for x in range(brown.CLASSES)}
        row[brown.NEW] = sum(row.values()) * once / total
        return (row[c] + 0.5) / (sum(row.values()) + 0.5 * (brown.CLASSES + 1))

    def probability(h, n, c):
        return (n + 1) * (0.8 * share(h, c) / (mass[c] if c != brown.NEW else v + 1) + 0.2 * base)

    for r in scored.collect():
        h, want = brown.START, 0.0
        for k, s in keys(texts[r.doc_id]):
            want += math.log10(probability(h, *of.get(k, (0, brown.NEW))))
            h = history(k, s)
        assert abs(r.score - want) < 1e-6 and r.n_known == sum(k in counts for k, _ in keys(texts[r.doc_id]))
    for h in range(brown.N_ALL):  # known words, as many new ones, and the unigram model's share of one new word
        known = sum(probability(h, n, c) for n, c in of.values())
        empty = sum(share(h, c) for c in range(brown.CLASSES) if not mass[c])
        new = 0.8 * share(h, brown.NEW) + 0.2 * base
        assert abs(known + new + 0.8 * empty - 1) < 1e-9


def test_the_exchange_ends_where_no_turn_gains(spark):
    rng = random.Random(6)
    kinds = [[f"{c}{k}" for k in range(40)] for c in "abc"]
    docs = spark.createDataFrame([(k, " ".join(rng.choice(kinds[j % 3]) for j in range(90)), True) for k in range(60)], "doc_id long, text string, learnt boolean")
    _, total, m, _ = brown.learnt_and_scored(docs)
    assert all(b >= a for a, b in zip(m.reached, m.reached[1:], strict=False)) and len(m.reached) > 4
    assert all(b - a < brown.LEAST_GAIN * total for a, b in zip(m.reached[-5:], m.reached[-4:], strict=False))


def brute_marginals(scores, move):
    from itertools import product

    n = len(scores)
    weight = {s: math.exp(sum(scores[i][s[i]] for i in range(n)) + sum(move[s[i - 1]][s[i]] for i in range(1, n))) for s in product((0, 1), repeat=n)}
    z = sum(weight.values())
    return [sum(w for s, w in weight.items() if s[i] == 1) / z for i in range(n)]


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    lines = np.array([1, 4, 2, 6])
    scores, move = rng.normal(size=(lines.sum(), 2)), rng.normal(size=(2, 2))
    got = quality.marginals(scores, lines, move)[0][:, 1]
    want = np.concatenate([brute_marginals(scores[a : a + n].tolist(), move.tolist()) for a, n in zip(np.cumsum(lines) - lines, lines, strict=True)])
    assert np.allclose(got, want)


def test_slope_of_the_objective():
    """Against differences of its value, with documents of many and of few lines."""
    rng = np.random.default_rng(2)
    lines, labels = np.array([1, 4, 2, 6]), np.array([1, 0, 1, 1])
    x, theta = rng.normal(size=(lines.sum(), 3)), rng.normal(size=7)
    slope = quality.objective(theta, x, lines, labels)[1]
    for k in range(7):
        step = np.eye(7)[k] * 1e-6
        assert abs((quality.objective(theta + step, x, lines, labels)[0] - quality.objective(theta - step, x, lines, labels)[0]) / 2e-6 - slope[k]) < 1e-6


def test_long_documents_are_learnt_from(spark):
    """What tells good from bad stands in one part of long documents only."""
    rng = random.Random(3)
    rows = []
    for k in range(160):
        lines = [prose(rng, 8) for _ in range(rng.randint(150, 400))]
        at = rng.randrange(len(lines) - 60)
        if k % 2 == 0:
            lines[at : at + 60] = ["BUY!!! | NOW $$$"] * 60
        rows.append((k, "\n".join(lines)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, quality int")
    scores = {r.doc_id: r.score for r in quality.score_documents(docs, labels).collect()}
    assert max(scores[k] for k, _ in rows if k % 2 == 0) < min(scores[k] for k, _ in rows if k % 2)
    used = quality.features_of(docs, labels).selectExpr("length(features) as n").collect()
    learnt = [t for k, t in rows if zlib.crc32(str(k).encode()) % 5]
    assert sorted(r.n // (4 * quality.OWN) for r in used) == sorted(t.count("\n") + 1 for t in learnt)


def test_the_fit_is_a_maximum(spark):
    """The slope of the whole sample's objective at the fitted weights, worked out in one place, is next to nothing."""
    docs, labels = labelled(spark, 150)
    model = quality.learn(docs, labels.union(labels))
    rows = quality.features_of(docs, labels).collect()
    own = [np.frombuffer(r.features, "<f4").reshape(-1, quality.OWN).astype(float) for r in rows]
    lines, whole = np.array([len(x) for x in own]), np.concatenate(own)
    assert np.allclose(model.centre, whole.mean(0)) and np.allclose(model.scale, whole.std(0) + 1e-3)
    x, y = quality.with_neighbours((whole - model.centre) / model.scale, lines), np.array([r.quality for r in rows])
    theta = np.concatenate((model.weights, model.move.reshape(-1)))
    value, slope = quality.objective(theta, x, lines, y)
    assert np.abs(slope).max() < 2 * quality.TOLERANCE
    rng = np.random.default_rng(4)
    assert all(quality.objective(theta + rng.normal(size=len(theta)) * 0.05, x, lines, y)[0] < value for _ in range(50))


def test_of_an_id_with_several_texts_one_is_learnt_from(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b\nb"), (2, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0)], "doc_id long, quality int")
    assert quality.features_of(docs, labels).count() == sum(zlib.crc32(str(k).encode()) % 5 > 0 for k in (1, 2))


def test_line_features():
    own, sizes, lines = quality.lines_of(pa.array(["ab AB\n\n12 | x", "", "\n", "q q q"]))
    assert lines.tolist() == [3, 1, 2, 1] and sizes.tolist() == [5, 0, 6, 0, 0, 0, 5]
    assert own[0][1] == own[0][2] == 0.4 and own[2][7] == 1 / 6 and own[6][14] == 2 / 3
    x = quality.with_neighbours(own, lines)
    assert (x[1][quality.OWN : 2 * quality.OWN] == own[0]).all() and not x[3][quality.OWN : 3 * quality.OWN].any()


def labelled(spark, n=400):
    rng = random.Random(9)
    rows, labels = [], []
    for k in range(n):
        good = rng.random() < 0.8
        lines = [prose(rng, rng.randint(4, 20)) for _ in range(rng.randint(1, 6))]
        rows.append((k, "\n".join(x if good else x.upper().replace(" ", "!! ") for x in lines)))
        labels.append((k, int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_quality_of_held_out_documents(spark):
    docs, labels = labelled(spark)
    rows = quality.score_documents(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 40 and sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    docs, labels = labelled(spark, 100)
    rows = quality.score_documents(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.score_documents(no_docs, labels).collect() == []
    assert all(abs(r.score - 0.5) < 1e-9 for r in quality.score_documents(docs, labels.limit(0)).collect())
    kept = quality.keep_good(odd_docs.join(docs.select("doc_id"), "doc_id", "left_anti"), labels)
    assert kept.columns == odd_docs.columns
    nulls = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    assert quality.score_documents(docs, labels.union(nulls)).count() == 100
