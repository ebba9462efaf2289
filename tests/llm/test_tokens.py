import hashlib
import random
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from quire.llm import bitpack, byte_bpe  # noqa: E402
from quire.llm._pieces import Splitter  # noqa: E402

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def given():
    import tiktoken

    return tiktoken.Encoding("given", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def odd_texts(seed, n=400):
    rng = random.Random(seed)
    pools = [range(32, 127), range(0, 256), range(0x370, 0x500), range(0x4E00, 0x4F00), range(0x1F600, 0x1F640), range(0x2000, 0x2070), [10, 32, 160, 0x3000]]
    return ["".join(chr(rng.choice(rng.choice(pools))) for _ in range(rng.randint(0, 60))) for _ in range(n)] + ["ab" * 20_000, " " * 5000, "<|endoftext|>", ""]


def test_bpe_equals_merging(given):
    bpe = byte_bpe.load(RANKS, P.PATTERN)
    for text in odd_texts(1):
        ids = bpe.encode(text)
        assert ids == given.encode_ordinary(text) and bpe.decode(ids) == text.encode()


def test_splitter_engines_agree():
    import regex

    slow, own = regex.compile(P.PATTERN).findall, Splitter(P.PATTERN)
    assert own.fast is not own.slow
    assert all(own(t) == slow(t) for t in odd_texts(2) + ["".join(map(chr, range(256))) * 2, "a's 't\x1c\x85b\xa0 \xaa\xb2"])


def test_bpe_of_odd_rows(spark, odd_docs, no_docs, given):
    rows = byte_bpe.encode_decode(odd_docs, RANKS, P.PATTERN, with_ids=True).collect()
    want = []
    for r in odd_docs.collect():
        ids = given.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest(), ids))
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)
    assert byte_bpe.encode_decode(no_docs, RANKS, P.PATTERN).collect() == []


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 31, 32])
def test_packing(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 63, 64, 65, 1000):
        ids = rng.integers(0, 1 << bits, n).astype(np.uint32)
        words = bitpack.pack(ids, bits)
        assert len(words) == -(-n // 64) * bits and (bitpack.unpack(words, n, bits) == ids).all()
    assert [bitpack.bits_for(n) for n in (1, 2, 3, 50_257, 65_536, 65_537)] == [1, 1, 2, 16, 16, 17]
    assert bitpack.vocabulary_of(JSON) == 50_257
    for bits in (3, 16):
        assert (bitpack.unpack(bitpack.pack(np.array([(1 << bits) - 1], np.uint32), bits), 1, bits) == [(1 << bits) - 1]).all()
        with pytest.raises(ValueError):
            bitpack.pack(np.array([0, 1 << bits], np.uint32), bits)


def test_piece_encoder_equals_the_library():
    encoder = bitpack.load(JSON, P.PATTERN)
    texts = odd_texts(3)
    for _ in range(2):
        assert [x.tolist() for x in encoder.encode(texts)] == [e.ids for e in encoder.tok.encode_batch(texts, add_special_tokens=False)]


def test_files_of_odd_rows(spark, odd_docs, no_docs):
    files = bitpack.write_ids(odd_docs, JSON, P.PATTERN, 2, 50_257)
    rows = bitpack.read_ids(spark, files).orderBy("start").collect()
    tok = bitpack.load(JSON, P.PATTERN).tok
    want, at = sorted(((r.doc_id, tok.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in odd_docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0)), 0
    assert [r.doc_id for r in rows] == [d for d, _ in want]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in rows) == sorted((d is None, d or 0, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in want)
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    assert bitpack.read_ids(spark, bitpack.write_ids(no_docs, JSON, P.PATTERN, 2, 50_257)).collect() == []


def test_random_access(tmp_path):
    rng = np.random.default_rng(5)
    docs = [rng.integers(0, 50_257, n).astype(np.uint32) for n in (5, 0, 200_000, 1, 70_000)]
    with open(tmp_path / "x.ids", "wb") as out:
        w = bitpack.Writer(out, 16)
        for k, d in enumerate(docs):
            w.add(None if k == 1 else k, d)
        w.close()
    r = bitpack.Reader(f"file://{tmp_path}/x.ids")
    assert all((r.document(k) == d).all() for k, d in enumerate(docs)) and r.there.tolist() == [True, False, True, True, True]
    whole = np.concatenate(docs)
    assert all((r.ids(a, b) == whole[a:b]).all() for a, b in [(0, 1), (63, 65), (131_000, 132_100), (270_000, 270_006)])
    (tmp_path / "y.ids").write_bytes((tmp_path / "x.ids").read_bytes()[:-5])
    with pytest.raises(ValueError):
        bitpack.Reader(f"file://{tmp_path}/y.ids")
