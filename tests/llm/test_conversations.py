import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import duckdb
import pytest

from quire.llm import conversations as C

SPACE = " \t\n\x0b\x0c\r"
COLUMNS = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        text = "" if code == 1 else re.sub(r"[.!?]", "", text) if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def brute(original, rows):
    """The rows of the contract by trying all edits of each place, strings included."""
    out = {}
    for conv in {r[0] for r in original}:
        own = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in own:
            plain = text.rstrip(SPACE)
            faults.append("blank" if not plain else "duplicate" if (role, text) in seen else "truncated" if plain[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        follows = {"": "su", "s": "u", "u": "a", "a": "u"}

        @lru_cache(None)
        def best(i, state, inserts=0, own=own, faults=faults, follows=follows):
            options = [(0, "", ())] if i == len(own) and state in ("", "a") else []
            if inserts < 3:
                for role in ("user", "assistant"):
                    if role[0] in follows[state]:
                        c, a, b = best(i, role[0], inserts + 1)
                        options.append((c + 3, "I" + a, (f"{role}:", *b)))
            if i < len(own):
                _, role, text = own[i]
                c, a, b = best(i + 1, state)
                options.append((c + 4, "D" + a, b))
                if faults[i] not in ("blank", "duplicate"):
                    for name, edit, cost in ((role, "K", 0), ("user", "R", 3), ("assistant", "R", 3)):
                        if name[:1] and name[0] in follows[state]:
                            c, a, b = best(i + 1, name[0])
                            options.append((c + cost + 3 * (faults[i] == "truncated"), edit + a, (f"{name}:{text}", *b)))
            return min(options, default=(10**9, "", ()))

        for i in range(len(own), -1, -1):  # from the end, as recursion is bounded
            best(i, "u"), best(i, "a"), best(i, "s"), best(i, "")
        cost, audit, body = best(0, "")
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(body).encode()).hexdigest())
    return out


def rows_of(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def made(rng, n, longest=9):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "usher", None]
    texts = ["Yes.", "no", "What?", "", " \n", "Yes.", "A long one, cut", "é!", None, "漢。", "done. \t"]
    return [(c, rng.choice([t, t, t, t + 1, None]), rng.choice(roles), rng.choice(texts)) for c in range(n) for t in range(rng.randint(1, longest))]


@pytest.mark.parametrize("block", [1, 2, 256])
def test_repair_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    rows = made(random.Random(block), 120)
    rows += [(None, 1, "user", "hi."), (None, None, None, None), (-5, 2**62, "user", "a."), (-5, -(2**62), "assistant", "b.")]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], f"{COLUMNS}, audit string, n int").repartition(3)
    got = C.audited(C.damaged(df))
    assert got.columns == ["conv_id", *C.RESULT]
    assert rows_of(got) == brute(rows, damage(rows))
    assert rows_of(C.audited(C.counted_once(df))) == brute(rows, [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows])


def test_sql_equals_brute_force():
    rows = made(random.Random(5), 150)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert {r[0]: r[1:] for r in con.execute(C.REPAIR_SQL).fetchall()} == brute(rows, damage(rows))


def test_empty_table_and_lost_conversations(spark):
    assert C.audited(C.damaged(spark.createDataFrame([], COLUMNS))).collect() == []
    lost = [(c, 0, "user", "a.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    zero = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert lost and rows_of(C.audited(C.damaged(spark.createDataFrame(lost, COLUMNS)))) == {r[0]: zero for r in lost}


def test_a_conversation_of_a_third_of_all_rows(spark, monkeypatch):
    """It spans ranges and blocks; repeated rows count."""
    monkeypatch.setattr(C, "BLOCK", 7)
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["same text.", f"own {t}.", "cut"])) for t in range(700)]
    rows += [(1, 3, "user", "copy.")] * 300 + [(k, t, "ua"[t % 2].replace("u", "user").replace("a", "assistant"), f"t{t}.") for k in range(2, 300) for t in range(6)]
    df = spark.createDataFrame(rows, COLUMNS).repartition(4)
    assert rows_of(C.audited(C.damaged(df))) == brute(rows, damage(rows))


def test_repaired_turns(spark, monkeypatch):
    for block in (2, 256):
        monkeypatch.setattr(C, "BLOCK", block)
        rows = made(random.Random(3), 60)
        damaged = C.damaged(spark.createDataFrame(rows, COLUMNS))
        turns = C.repaired(damaged).orderBy("conv_id", "place").collect()
        want = brute(rows, damage(rows))
        for conv, found in itertools.groupby(turns, lambda r: r.conv_id):
            found = list(found)
            assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in found))
            assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in found).encode()).hexdigest() == want[conv][-1]
            assert [r.edit for r in found] == [e for e in want[conv][6] if e != "D"]
