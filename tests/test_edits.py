import random
import tracemalloc

import pytest

from quire.functions import edits
from quire.operators import align_fuzzy, spans
from quire.spec import LayoutSpec

from .spec import model


def plain_script(a, b):
    """The script by the whole table and the rule: from the end back a deletion, an insertion, then a match or replacement."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    d = [[i + j for j in range(len(y) + 1)] for i in range(len(x) + 1)]
    for i in range(1, len(x) + 1):
        for j in range(1, len(y) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (x[i - 1] != y[j - 1]))
    i, j, steps = len(x), len(y), ["equal"] * tail
    while i or j:
        if not j or (i and d[i - 1][j] + 1 == d[i][j]):
            steps.append("delete")
        elif not i or d[i][j - 1] + 1 == d[i][j]:
            steps.append("insert")
        else:
            steps.append("equal" if x[i - 1] == y[j - 1] else "replace")
        i, j = i - (steps[-1] != "insert"), j - (steps[-1] != "delete")
    return ["equal"] * head + steps[::-1]


@pytest.mark.parametrize("part", [2, 3, 64])
def test_scripts_follow_the_rule(monkeypatch, part):
    monkeypatch.setattr(edits, "PART", part)
    rng = random.Random(part)
    for _ in range(400):
        a, b = ("".join(rng.choice("abcé漢\U0001f600"[: rng.randint(1, 6)]) for _ in range(rng.randint(0, 40))) for _ in range(2))
        got = [tag for tag, i, j, k, m in edits.opcodes(a, b) for _ in range(max(j - i, m - k))]
        assert got == plain_script(a, b), (a, b)
        assert sum(s != "equal" for s in got) == model.distance(a, b)


def test_distant_texts_take_memory_by_their_length():
    rng = random.Random(4)
    a, b = ("".join(rng.choice("abcdefgh") for _ in range(12_000)) for _ in range(2))
    tracemalloc.start()
    edits.opcodes(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 * len(a)  # the table would take a byte for each of 144 million cells


def first_block(pos, ops, end):
    """A boundary by the first block whose closed range holds it."""
    for tag, s, e, t, u in ops:
        if s <= pos <= e:
            if tag == "equal":
                return t + pos - s
            if tag == "replace":
                return t + round((pos - s) / max(1, e - s) * (u - t))
            return t if tag == "delete" or not end else u
    return max((op[4] for op in ops), default=0)


def test_boundaries_are_carried_by_the_first_block(spark):
    rng, rows = random.Random(8), []
    for surah in range(1, 60):
        verses = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(1, 6))]
        other = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(0 if surah % 7 == 0 else 1, 6))]
        rows += [(1, surah, k, t) for k, t in enumerate(verses)] + [(2, surah, k, t) for k, t in enumerate(other)]
    df = spark.createDataFrame(rows, "edition_id int, surah int, ayah int, text string")
    placed = spans.verse_spans(df, df["text"])
    target = placed.filter("edition_id = 1").drop("edition_id")
    got = {(r.surah, r.ayah): (r.dest_start, r.dest_stop) for r in spans.mapped_spans(placed.filter("edition_id = 2"), target.toDF(*target.columns)).collect()}
    want = {}
    for surah in range(1, 60):
        texts = {e: [t for x, s, _, t in rows if (x, s) == (e, surah)] for e in (1, 2)}
        ops, at = edits.opcodes("".join(texts[2]), "".join(texts[1])), 0
        for k, t in enumerate(texts[2]):
            ends = first_block(at, ops, False), first_block(at + len(t), ops, True)
            want[surah, k], at = (min(ends), max(ends)), at + len(t)
    assert got == want


def test_distances_of_all_starts_in_one_pass():
    rng = random.Random(6)
    for _ in range(300):
        words = [{"surah": 1 + (k > 6), "ayah": 1, "f": "".join(rng.choice("abc") for _ in range(rng.randint(0, 4)))} for k in range(12)]
        target, limit, most = "".join(rng.choice("abc") for _ in range(rng.randint(0, 9))), rng.randint(0, 6), rng.randint(1, 8)
        starts = rng.sample(range(12), rng.randint(1, 5))
        got = align_fuzzy.distances(target, words, starts, 1, limit, most)
        for start in starts:
            want = []
            for end in range(start + 1, min(start + most, 12) + 1):
                if words[end - 1]["surah"] != 1:
                    break
                d = model.distance(target, "".join(w["f"] for w in words[start:end]))
                want += [(end, d)] if d <= limit else []
            assert got[start] == want


def test_least_total_over_all_cuts():
    rng = random.Random(7)
    spec = LayoutSpec(max_words=4)
    for _ in range(200):
        words = [{"surah": 1, "ayah": k // 2, "f": "".join(rng.choice("ab") for _ in range(rng.randint(1, 3)))} for k in range(rng.randint(1, 7))]
        segments = [{"line": k, "text": "", "surah": 1, "marker": rng.choice([None, None, 1]), "f": "".join(rng.choice("ab") for _ in range(rng.randint(1, 5)))} for k in range(rng.randint(1, 3))]

        def best(k, at, words=words, segments=segments):
            if k == len(segments):
                return 0 if at == len(words) else None
            out = []
            for end in range(at + 1, min(at + 4, len(words)) + 1):
                s = segments[k]
                d = model.distance(s["f"], "".join(w["f"] for w in words[at:end]))
                rest = best(k + 1, end)
                if rest is not None and d <= align_fuzzy.limit_of(len(s["f"]), spec) and s["marker"] in (None, words[end - 1]["ayah"]):
                    out.append(d + rest)
            return min(out, default=None)

        path, status, _ = align_fuzzy.align_words(segments, words, spec)
        assert (sum(d for _, _, d in path) if status == "ok" else None) == best(0, 0)


def test_alike_texts_do_not_take_the_table(monkeypatch):
    """Few edits beside a missing passage are found on diagonals: no row of the table is made, however long the texts."""
    monkeypatch.setattr(edits.Table, "after", lambda *_: pytest.fail("a row of the table"))
    rng = random.Random(9)
    a = "".join(rng.choice("abcdefgh ") for _ in range(60_000))
    b = a[:100] + "@" + a[100:7000] + a[7700:20_000] + "#" + a[20_001:]
    assert edits.opcodes(b, a)[:2] == [("equal", 0, 100, 0, 100), ("delete", 100, 101, 100, 100)]
    assert sum(max(j - i, m - k) for tag, i, j, k, m in edits.opcodes(b, a) if tag != "equal") == 702


def test_near_scripts_are_those_of_the_table():
    rng = random.Random(10)
    near = 0
    for _ in range(600):
        a = "".join(rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(1, 60)))
        b = list(a)
        for _ in range(rng.randint(1, 5)):
            at = rng.randint(0, len(b))
            b[at : at + rng.choice([0, 1, 1, 12])] = rng.choice(["", "a", "b", "x", "aaaa"])
        b = "".join(b)
        near += edits.near_script(a, b) is not None
        assert [tag for tag, i, j, k, m in edits.opcodes(a, b) for _ in range(max(j - i, m - k))] == plain_script(a, b), (a, b)
    assert near > 200


def test_scripts_are_made_once(spark):
    """Blocks meet the boundaries without a second use: one Python step in the plan, also for ranges over many bins."""
    df = spark.createDataFrame([(e, 1, k, "ab" * (90_000 if k == 1 else 3) + str(k * e)) for e in (1, 2) for k in range(4)], "edition_id int, surah int, ayah int, text string")
    placed = spans.verse_spans(df, df["text"])
    target = placed.filter("edition_id = 1").drop("edition_id")
    got = spans.mapped_spans(placed.filter("edition_id = 2"), target.toDF(*target.columns))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert sorted((r.ayah, r.dest_start, r.dest_stop) for r in got.collect()) == [(0, 0, 7), (1, 7, 180_008), (2, 180_008, 180_015), (3, 180_015, 180_022)]


def test_pages_reach_python_as_columns():
    """Lists of structs are taken apart by field, with nulls and in slices; starts that have read too little are not looked at."""
    import pyarrow as pa

    rows = [[{"a": 1, "b": "x"}, {"a": None, "b": "y"}], None, [], [{"a": 3, "b": None}]]
    column = pa.array(rows, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.string())])))
    assert list(align_fuzzy.records(column)) == [r or [] for r in rows] and list(align_fuzzy.records(column.slice(1))) == [r or [] for r in rows[1:]]
