"""Byte-level BPE by longest matches and backtracking.

Bytes become Latin-1 characters, so that an Aho-Corasick automaton finds in one pass the longest vocabulary entry at
every offset of a pre-token. A left-to-right walk takes the longest entry, checks that it may stand beside the entry
before it, falls back to shorter prefixes and, when none fits, steps back one entry. Two entries may be neighbours
exactly if merging their joined bytes gives those two entries again; this answer is memoised. Offsets that failed are
marked, so that each is left at most once and the walk is linear. The result equals that of merging by rank.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import small_batches, text_of, tidied
from ._pieces import Splitter

#: Pre-tokens that a worker remembers before the older half goes.
REMEMBERED = 250_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class ByteBPE:
    """Exact BPE over ranks (bytes -> id, lower merges first) after splitting by a pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick

        self.ranks, self.bytes_of = ranks, {i: b for b, i in ranks.items()}
        self.split = Splitter(pattern)
        self.automaton = ahocorasick.Automaton()
        for token, i in ranks.items():
            if self.merged(token) == [i]:  # an entry that merging never yields is no match
                self.automaton.add_word(token.decode("latin-1"), (i, len(token)))
        self.automaton.make_automaton()
        self.usable = {i for _, (i, _) in self.automaton.items()}
        self.beside: dict[tuple[int, int], bool] = {}
        self.shorter: dict[int, int | None] = {}
        self.decimal = {i: str(i) for i in self.bytes_of}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, data: bytes) -> list[int]:
        """Plain merging by rank; for short inputs."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min(((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def fits(self, left: int, right: int) -> bool:
        key = (left, right)
        found = self.beside.get(key)
        if found is None:
            found = self.beside[key] = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return found

    def prefix(self, token: int) -> int | None:
        """The longest usable entry that is a proper prefix of this one."""
        if token not in self.shorter:
            data = self.bytes_of[token]
            found = (self.ranks.get(data[:n]) for n in range(len(data) - 1, 0, -1))
            self.shorter[token] = next((i for i in found if i in self.usable), None)
        return self.shorter[token]

    def piece(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        longest: list[int | None] = [None] * (len(data) + 1)
        for end, (token, length) in self.automaton.iter(data.decode("latin-1")):
            longest[end - length + 1] = token  # for one start, ends come in rising order
        open_at = bytearray(b"\1") * (len(data) + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < len(data):
            while token is not None:
                end = at + len(self.bytes_of[token])
                if open_at[end] and (not out or self.fits(out[-1], token)):
                    break
                token = self.prefix(token)
            if token is None:
                open_at[at] = 0
                token = out.pop()
                at -= len(self.bytes_of[token])
            else:
                out.append(token)
                at, token = end, longest[end]
        return out

    def remember(self, text: str) -> bytes:
        found = self.older.get(text)
        if found is None:
            found = np.array(self.piece(text.encode("utf-8", "surrogatepass")), "<u4").tobytes()
        self.known[text] = found
        return found

    def encode(self, text: str) -> list[int]:
        """Ids of a text: those of its pre-tokens, which are remembered as packed bytes."""
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        if len(self.beside) > 2 * REMEMBERED:
            self.beside.clear()
        get, remember = self.known.get, self.remember
        return np.frombuffer(b"".join([get(p) or remember(p) for p in self.split(text)]), "<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_loaded: dict[tuple[str, str], ByteBPE] = {}


def load(path: str, pattern: str) -> ByteBPE:
    """One encoder for each Python worker; it outlives a task."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = ByteBPE(read_ranks(path), pattern)
    return _loaded[path, pattern]


def encode_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encodes each text, decodes the ids again and returns one row per row: the id, n_tokens, ids_sha256,
    decoded_sha256 and, if asked for, the ids themselves.

    A null text is the empty text: no ids, the digests of the empty string. Texts are taken whole; repeated rows give
    repeated rows; other columns do not pass. One narrow stage, no shuffle; a worker holds one small batch.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        sha = hashlib.sha256
        for batch in batches:
            counts, digests, decoded, kept = [], [], [], []
            for text in batch.column(1).to_pylist():
                ids = bpe.encode(text)
                counts.append(len(ids))
                digests.append(sha(",".join(map(bpe.decimal.__getitem__, ids)).encode()).hexdigest())
                decoded.append(sha(bpe.decode(ids)).hexdigest())
                if with_ids:
                    kept.append(ids)
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    given = docs.select(F.col(id_col), text_of(text_col).alias(text_col))
    kind = given.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return given.mapInArrow(tidied(run), schema)
