import hashlib
from collections import Counter

import duckdb
import pytest

pipeline = pytest.importorskip("corpus_pipeline")
P = pytest.importorskip("public_tokenizers")

from quire.llm import byte_bpe, mixing  # noqa: E402

from .test_documents import classes  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The input of each stage, and the result."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF).persist()
        tables.append(docs)
    return tables


def test_columns_and_texts(stages):
    names, given = stages[0].columns, {tuple(r) for r in stages[0].collect()}
    for out in stages[1:-1]:
        assert out.columns == names and {tuple(r) for r in out.collect()} <= given


def test_quality_stage(spark, stages):
    """Labelled documents stay or go as labelled."""
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    assert kept & set(labels) == {i for i, q in labels.items() if q == 1} and len(kept) < stages[0].count()


def test_near_dedup_stage(stages):
    rows = sorted((r.doc_id, r.text) for r in stages[1].collect())
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(set(classes(rows).values()))
    assert stages[2].count() < len(rows)


def test_mixing_stage(stages):
    con = duckdb.connect()
    con.register("documents", stages[2].toArrow())
    sql = mixing.MIX_SQL.replace(f"ln({mixing.QUERY_REPEATS})", f"ln({pipeline.REPEATS})")
    want = Counter(r[0] for r in con.execute(f"SELECT doc_id FROM ({sql})").fetchall())
    got = Counter(r.doc_id for r in stages[3].collect())
    assert got == want and max(got.values()) == 2 and set(got) == {r.doc_id for r in stages[2].collect()}


def test_encoding_stage(stages):
    import tiktoken

    e = tiktoken.Encoding("given", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    text = {r.doc_id: r.text for r in stages[3].collect()}
    rows = stages[4].collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in stages[3].collect())
    for r in rows:
        ids = e.encode_ordinary(text[r.doc_id])
        assert list(r.ids) == ids and r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_run(spark, stages):
    rows = pipeline.run(spark, SF)
    assert sorted(map(str, rows.collect())) == sorted(map(str, stages[4].collect()))


@pytest.mark.parametrize("stage", range(4))
def test_stages_of_odd_rows(spark, odd_docs, no_docs, stage):
    """Nulls, ties, repeated rows and other columns of clashing names; what stays is as it was."""
    name, run = pipeline.STAGES[stage]
    given = Counter(map(tuple, odd_docs.collect()))
    out = run(spark, odd_docs, SF)
    rows = out.collect()
    assert run(spark, no_docs, SF).collect() == []
    if name == "byte_bpe":
        assert Counter(r.doc_id for r in rows) == Counter(k[0] for k in given.elements())
        return
    got = Counter(map(tuple, rows))
    assert out.columns == odd_docs.columns and set(got) <= set(given)
    if name == "quality":
        assert all(got[r] == given[r] for r in got)  # repeated rows stay or go together
    elif name == "near_dedup":
        assert set(got.values()) == {1} and len({r.text or "" for r in rows}) == len(rows)
        assert {r.text or "" for r in rows} <= {k[1] or "" for k in given}
    else:
        assert all(got[r] >= given[r] for r in given)
