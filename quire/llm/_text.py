"""Vectorised words of Arrow text: byte classes and 64-bit word hashes, without a Python object for each word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that are worked on at once; longer texts are cut at spaces.
CHUNK = 1 << 21

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_random = np.random.default_rng(20240229)
LETTER = _random.integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
STEP = 0x9E3779B97F4A7C15
POWER = np.array([pow(STEP, k, 1 << 64) for k in range(1 << 12)], np.uint64)
MIX = np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    h = (h ^ (h >> np.uint64(29))) * MIX
    return h ^ (h >> np.uint64(32))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of texts without nulls."""
    texts = texts.cast(pa.large_string())
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    own = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return own[at[0] : at[-1]], at - at[0]


def stretches(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(starts, texts): runs of whole texts, or pieces of a long one cut at spaces, of about CHUNK bytes; starts has the
    end too."""
    starts, of = [], []
    held = 0
    for k in range(len(offsets) - 1):
        low, high = int(offsets[k]), int(offsets[k + 1])
        while True:
            cut = high
            if high - low > CHUNK:
                spaces = np.flatnonzero(SPACE[data[low + CHUNK : high]])
                cut = low + CHUNK + int(spaces[0]) if len(spaces) else high
            starts.append(low)
            of.append(k)
            held += cut - low
            low = cut
            if held >= CHUNK:
                yield np.array([*starts, cut], np.int64), np.array(of, np.int64)
                starts, of, held = [], [], 0
            if cut == high:
                break
    if starts:
        yield np.array([*starts, int(offsets[-1])], np.int64), np.array(of, np.int64)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, texts, places) of all words in order: maximal runs of bytes that are no ASCII space, A-Z in lower case;
    the text that a word is in, and its first byte's place in the data."""
    return sized_words(data, offsets)[:3]


def sized_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As words(), with the bytes of each word."""
    hashes, texts, places, sizes = [], [], [], []
    for starts, of in stretches(data, offsets):
        base, end = int(starts[0]), int(starts[-1])
        if base == end:
            continue
        own = LOWER[data[base:end]]
        solid = ~SPACE[own]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        heads = starts[:-1][np.diff(starts) > 0] - base
        first[heads] = solid[heads]
        at = np.flatnonzero(first)
        if not len(at):
            continue
        lengths = np.diff(at, append=len(own))
        within = np.arange(at[0], len(own)) - np.repeat(at, lengths)
        value = LETTER[own[at[0] :]] * POWER[within & (len(POWER) - 1)]
        value[~solid[at[0] :]] = 0
        hashes.append(mix(np.add.reduceat(value, at - at[0])))
        places.append(at + base)
        sizes.append(np.add.reduceat(solid[at[0] :], at - at[0], dtype=np.int64))
        texts.append(of[np.searchsorted(starts, at + base, side="right") - 1])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(texts), np.concatenate(places), np.concatenate(sizes)
