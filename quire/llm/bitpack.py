"""Token ids in files of fixed-width bit packing.

An id takes the fewest bits that the vocabulary needs. Ids are packed in blocks of BLOCK ids, each padded to whole
64-bit words, so that a block starts at a known offset and numpy unpacks it in one go. A file holds, in order: the
magic and a small header, the blocks, a document table (id, validity, number of ids) and a trailer with the places
of all of these. Any range of ids is read with one range read of the blocks that cover it.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import make_dir, new_path, open_fs, put_file, small_batches, text_of, tidied
from ._pieces import Splitter

MAGIC = b"QIDS0001"
#: ids in a block, a multiple of 64.
BLOCK = 1 << 16
#: ids that a reader holds at once, about.
READ = 1 << 20
#: Widths of machine words: these need no shifts.
WHOLE = {8: "<u1", 16: "<u2", 32: "<u4"}
TRAILER = struct.Struct("<QQQIII")  # documents, ids, offset of the document table, bits, block, unused
#: Characters that are split and looked up at once: what stays in a processor's cache.
TOGETHER = 1 << 18
#: Pre-tokens that a worker remembers before the older half goes.
REMEMBERED = 700_000


def bits_for(vocabulary: int) -> int:
    """The fewest bits that tell the ids 0 .. vocabulary - 1 apart."""
    return max(1, (max(vocabulary, 1) - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """Little-endian 64-bit words; 64 ids fill exactly ``bits`` words. An id that needs more bits is an error."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {int(ids.max())} needs more than {bits} bits")
    rows = -(-len(ids) // 64)
    if bits in WHOLE:
        whole = np.zeros(rows * 64, WHOLE[bits])
        whole[: len(ids)] = ids
        return whole.view("<u8")
    full = np.zeros(rows * 64, np.uint64)
    full[: len(ids)] = ids
    lanes, words = full.reshape(rows, 64), np.zeros((rows, bits), np.uint64)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        words[:, word] |= lanes[:, k] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, k] >> np.uint64(64 - shift)
    return words.reshape(-1)


def unpack(words: np.ndarray, n: int, bits: int) -> np.ndarray:
    if bits in WHOLE:
        return words.view(WHOLE[bits])[:n].astype(np.uint32)
    words = words.reshape(-1, bits)
    out, mask = np.empty((len(words), 64), np.uint32), np.uint64((1 << bits) - 1)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        x = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            x = x | (words[:, word + 1] << np.uint64(64 - shift))
        out[:, k] = x & mask
    return out.reshape(-1)[:n]


def vocabulary_of(tokenizer: str) -> int:
    """One more than the largest id of a tokenizer's file, added tokens included."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True).values(), default=-1) + 1


class Writer:
    """Streams ids of documents, in the order given, to one file."""

    def __init__(self, out, bits: int):
        self.out, self.bits = out, bits
        self.rest, self.held, self.at, self.ids = [], 0, len(MAGIC), 0
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids))
        self.rest.append(ids)
        self.held += len(ids)
        if self.held >= 4 * BLOCK:
            self.flush(self.held // BLOCK * BLOCK)

    def flush(self, n: int) -> None:
        ids = np.concatenate(self.rest) if self.rest else np.zeros(0, np.uint32)
        data = pack(ids[:n], self.bits).astype("<u8").tobytes()
        self.out.write(data)
        self.at, self.ids, self.rest, self.held = self.at + len(data), self.ids + n, [ids[n:]], self.held - n

    def close(self) -> None:
        self.flush(self.held)
        ids = np.array([0 if x is None else x for x in self.doc_ids], "<i8")
        there = np.array([x is not None for x in self.doc_ids], np.uint8)
        self.out.write(ids.tobytes() + there.tobytes() + np.array(self.counts, "<u8").tobytes())
        self.out.write(TRAILER.pack(len(self.counts), self.ids, self.at, self.bits, BLOCK, 0) + MAGIC)


class Reader:
    """Random access to a file of Writer."""

    def __init__(self, uri: str):
        system, path = open_fs(uri)
        self.file = system.open_input_file(path)
        end = self.file.size() - len(MAGIC) - TRAILER.size
        tail = self.file.read_at(TRAILER.size + len(MAGIC), end)
        if tail[-len(MAGIC) :] != MAGIC:
            raise ValueError(f"{uri} is no complete file of token ids")
        self.n_docs, self.n_ids, table, self.bits, self.block, _ = TRAILER.unpack(tail[: TRAILER.size])
        n, raw = self.n_docs, self.file.read_at(end - table, table)
        self.doc_ids = np.frombuffer(raw, "<i8", n)
        self.there = np.frombuffer(raw, np.uint8, n, 8 * n).astype(bool)
        self.counts = np.frombuffer(raw[9 * n :], "<u8", n).astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start .. stop - 1 of the file, by one range read."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first = start // 64 * 64  # every 64 ids begin at a word
        words = -(-(stop - first) // 64) * self.bits
        raw = self.file.read_at(words * 8, len(MAGIC) + first // 64 * self.bits * 8)
        return unpack(np.frombuffer(raw, "<u8"), stop - first, self.bits)[start - first :]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k] + self.counts[k]))


class PieceEncoder:
    """A tokenizers-library tokenizer that encodes each distinct pre-token once.

    Byte-level BPE works on each match of its pre-tokenizer's pattern alone, so that the ids of a text are those of its
    matches in order. Texts with an added token's string, and characters that the pattern's engine here may class in
    another way than the library does, are handed to the library whole.
    """

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks fill the cores already
        self.tok = Tokenizer.from_file(path)
        self.split = Splitter(pattern)
        added = [regex.escape(t.content) for t in self.tok.get_added_tokens_decoder().values()]
        self.added = regex.compile("|".join(added) or "(?!)").search
        # blocks whose characters all Unicode versions of the last decade class alike
        self.unsure = regex.compile(r"[^\x00-\u02ff\u0391-\u03a1\u03a3-\u03ff\u0400-\u0481\u048a-\u04ff\u05d0-\u05ea\u2010-\u2027\u2030-\u205e\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]").search
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, text: str) -> bool:
        return bool(self.added(text) or not text.isascii() and self.unsure(text))

    def learn(self, pieces: list[str]) -> None:
        """Encodes new pieces. Words that start with a space are split alike when they stand in one string, so that a
        single call encodes many of them."""
        if self.older:
            again = [(p, x) for p, x in zip(pieces, map(self.older.get, pieces), strict=True) if x is not None]
            self.known.update(again)
            pieces = [p for p in pieces if p not in self.known] if again else pieces
        words, others = [], []
        for p in pieces:
            (words if p[0] == " " and p[1:].isalpha() else others).append(p)
        for at in range(0, len(words), 256):
            part = words[at : at + 256]
            e = self.tok.encode("".join(part), add_special_tokens=False)
            packed, cuts = np.array(e.ids, "<u4").tobytes(), (4 * np.flatnonzero(np.diff(np.array(e.word_ids), prepend=-1))).tolist()
            if len(cuts) != len(part):
                others += part
                continue
            self.known.update(zip(part, map(packed.__getitem__, map(slice, cuts, [*cuts[1:], len(packed)])), strict=True))
        for at in range(0, len(others), 4096):
            part = others[at : at + 4096]
            for p, e in zip(part, self.tok.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.known[p] = np.array(e.ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out, low, held = [], 0, 0
        for k, text in enumerate(texts, 1):
            held += len(text)
            if held >= TOGETHER or k == len(texts):
                out += self.encode_some(texts[low:k])
                low, held = k, 0
        return out

    def encode_some(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        split = [() if self.whole(t) else self.split(t) for t in texts]
        found = [list(map(self.known.get, pieces)) for pieces in split]
        new = [[k for k, x in enumerate(ids) if x is None] for ids in found]
        self.learn(list({pieces[k] for pieces, at in zip(split, new, strict=True) for k in at}))
        out = []
        for text, pieces, ids, at in zip(texts, split, found, new, strict=True):
            for k in at:
                ids[k] = self.known[pieces[k]]
            out.append(np.frombuffer(b"".join(ids), "<u4") if pieces or not text else np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32))
        return out


_loaded: dict[tuple[str, str], PieceEncoder] = {}


def load(path: str, pattern: str) -> PieceEncoder:
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = PieceEncoder(path, pattern)
    return _loaded[path, pattern]


def write_ids(docs: DataFrame, tokenizer: str, pattern: str, end_id: int, vocabulary: int, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int, int]]:
    """Encodes all texts and writes their ids in ascending id order; returns (file, documents, ids) in that order.

    A null text is the empty text, which gives the end id alone. Null ids come first; rows of equal id follow each
    other in the order of their texts' hashes. Other columns are not read. Texts are range-partitioned by id before
    they are encoded; each task streams one file, and only one row per file comes to the driver.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder, bits = make_dir(new_path(spark, "token-ids")), bits_for(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        encoder = load(tokenizer, pattern)
        uri = f"{folder}/{uuid.uuid4().hex}.ids"
        end = np.array([end_id], np.uint32)
        low, said = first.column(0)[0].as_py(), []

        def write(out) -> None:
            w = Writer(out, bits)
            for batch in (x for group in ((first,), batches) for x in group):
                for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist()), strict=True):
                    w.add(doc_id, np.concatenate((ids, end)))
            w.close()
            said.extend((len(w.counts), w.ids))

        put_file(uri, write)
        order = pa.array([first.column(2)[0].as_py()], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([low], pa.int64()), order, pa.array([uri]), pa.array([said[0]], pa.int64()), pa.array([said[1]], pa.int64())], names=["low", "tie", "file", "n_docs", "n_ids"])

    given = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    placed = given.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
    files = placed.mapInArrow(tidied(run), "low bigint, tie bigint, file string, n_docs bigint, n_ids bigint").collect()  # one row per file
    files.sort(key=lambda r: (r.low is not None, r.low or 0, r.tie))
    return [(r.file, r.n_docs, r.n_ids) for r in files]


def read_ids(spark, files: list[tuple[str, int, int]]) -> DataFrame:
    """One row per document of the files, read back: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 (of the ids as little-endian 32-bit integers)."""
    at, rows = 0, []
    for name, _, n in files:
        rows.append((name, at))
        at += n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                r, k = Reader(name), 0
                while k < r.n_docs:
                    stop = max(k + 1, int(np.searchsorted(r.starts, r.starts[k] + READ)))
                    low, high = int(r.starts[k]), int(r.starts[stop - 1] + r.counts[stop - 1])
                    ids = r.ids(low, high).astype("<u4", copy=False)
                    cuts = r.starts[k:stop] - low
                    crc = [zlib.crc32(ids[a : a + n]) for a, n in zip(cuts, r.counts[k:stop], strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(r.doc_ids[k:stop], pa.int64(), mask=~r.there[k:stop]), pa.array(r.starts[k:stop] + before), pa.array(r.counts[k:stop]), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                    k = stop

    listed = spark.createDataFrame(rows, "file string, before bigint").repartition(max(1, len(rows)))
    return listed.mapInArrow(tidied(run), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
