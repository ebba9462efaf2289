"""Language-model scores by Brown's class-based bigrams.

A word's probability is that of its class after the word before it, times that of the word in its class, smoothed by
adding to the counts and by mixing with the unigram model. Every word of the training texts gets one of CLASSES classes.
The CLUSTERED most frequent ones (whole levels of counts) get theirs by exchange: from counts of neighbouring words,
every word's gain in likelihood of moving to each class is found at once, the moves that gain are made for a half of the
words in turn, by fewer and fewer of them if they do not raise the likelihood together, until QUIET turns in a row
each raise it by less than LEAST_GAIN a token. Then every other word goes to the class that makes its occurrences most likely. As the word
before, such a rare word stands for its length; so does a word that training lacks, which is predicted by a class of its
own: its counts are those of the words seen once, dealt out evenly over as many new words as there are known ones.
Counts cover every word of every training text. Words are known by 64-bit hashes.

Only what is bounded is sent around: the classes and counts of frequent words and the classes' bigrams. The counts and
classes of all other words are joined to the documents' words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import drop_table, id_hash_mod, small_batches, text_of, tidied, write_table
from ._text import mix, raw, sized_words

#: Words that the exchange itself gives classes to, at most.
CLUSTERED = 1 << 16
#: Words whose counts and classes are sent to all tasks, at most: 17 bytes each.
COUNTED = 1 << 19
CLASSES = 64
#: Longest bytes of the lengths that rare words before others are known by; one more has longer ones.
LENGTHS = np.array([2, 4, 6, 8, 10, 13, 17])
#: The exchange ends when so many turns in a row each raise the log likelihood of a token by less than LEAST_GAIN.
QUIET, LEAST_GAIN = 4, 0.01
#: Slices of the words that neighbours' counts are gathered by.
SLICES = 256
#: Added to the counts of class bigrams.
ADDED = 0.5
#: Share of the class model in the mixture.
SHARE = 0.8
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: The hash that stands for the end of a text.
END = np.uint64(0x5851F42D4C957F2D)
N_ALL = CLASSES + len(LENGTHS) + 2  # what comes before: a class, a length, the start of a text
START = N_ALL - 1
NEW = CLASSES  # the class of new words, after all others


#: Keys that a task counts before it passes them on, and new ones that it gathers before it sorts them in.
FULL, GATHERED = 1 << 20, 1 << 19


class Tally:
    """Counts of 64-bit keys in sorted arrays."""

    def __init__(self) -> None:
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.new: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        if counts is None:
            keys, counts = np.unique(keys, return_counts=True)
        self.new.append((keys, counts))
        self.held += len(keys)
        if self.held > GATHERED:
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *[k for k, _ in self.new]])
        counts = np.concatenate([self.counts, *[c for _, c in self.new]])
        self.new, self.held = [], 0
        if len(keys):
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            keys, counts = keys[first], np.add.reduceat(counts, first)
        self.keys, self.counts = keys, counts


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, length classes, texts) of the words of all texts in order, each text's end as its last one."""
    data, offsets = raw(texts)
    hashes, of, _, sizes = sized_words(data, offsets)
    n = len(texts)
    at = np.arange(len(hashes)) + of  # each text before adds an end
    ends = np.cumsum(np.bincount(of, minlength=n) + 1) - 1
    out, shapes, where = np.full(len(hashes) + n, END), np.zeros(len(hashes) + n, np.int64), np.empty(len(hashes) + n, np.int64)
    out[at], shapes[at], where[at] = hashes, np.searchsorted(LENGTHS, sizes), of
    where[ends] = np.arange(n)
    return out, shapes, where


def count_words(docs: DataFrame) -> DataFrame:
    """(word, shape, n) of all words of ``text``, ends included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(tally: Tally) -> Iterator[pa.RecordBatch]:
            tally.merge()
            for k in range(0, len(tally.keys), 1 << 16):
                part = slice(k, k + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(tally.keys[part]), pa.array(shape_of[part]), pa.array(tally.counts[part])], names=["word", "shape", "n"])

        tally, shapes = Tally(), {}
        for batch in batches:
            if not batch.num_rows:
                continue
            h, s, _ = tokens(batch.column(0))
            # the shape takes the place of the hash's lowest bits on the way: both are one key
            tally.add((h.view(np.int64) & ~np.int64(7)) | s)
            if len(tally.keys) > FULL:
                tally.merge()
                shape_of = (tally.keys & 7).astype(np.int8)
                yield from out(tally)
                tally = Tally()
        tally.merge()
        shape_of = (tally.keys & 7).astype(np.int8)
        yield from out(tally)

    small_batches(docs.sparkSession)
    return docs.select("text").mapInArrow(tidied(run), "word bigint, shape tinyint, n bigint").groupBy("word", "shape").agg(F.sum("n").alias("n"))


def level(n: str) -> F.Column:
    """Sixteen levels for each doubling of a count."""
    return F.floor(F.log2(F.col(n).cast("double")) * 16).cast("int")


@dataclass
class Vocabulary:
    """Sorted words with their counts, and the number of each in the clustered ones or -1."""

    words: np.ndarray
    counts: np.ndarray
    unit: np.ndarray
    n_units: int
    total: int
    distinct: int
    low: int

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of keys in ``words``, -1 for others."""
        at = np.minimum(np.searchsorted(self.words, keys), max(0, len(self.words) - 1))
        return np.where(self.words[at] == keys, at, -1) if len(self.words) else np.full(len(keys), -1)


def key_of(hashes: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.int64) & ~np.int64(7)) | shapes


def vocabulary(counts: DataFrame) -> Vocabulary:
    levels = counts.groupBy(level("n").alias("level")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).orderBy(F.desc("level")).collect()  # some hundred rows
    total, distinct = sum(r.n for r in levels), sum(r.words for r in levels)

    def least(most: int) -> int:
        """The lowest level down to which at most ``most`` words lie."""
        held, low = 0, 1 << 30
        for r in levels:
            held += r.words
            if held > most:
                break
            low = r.level
        return low

    low, own = least(COUNTED), least(CLUSTERED)
    found = counts.filter(level("n") >= low).select("word", "n", (level("n") >= own).alias("own")).toArrow()  # at most COUNTED rows
    words, n = found.column("word").to_numpy(), found.column("n").to_numpy()
    own_words = found.column("own").to_numpy(zero_copy_only=False).astype(bool)
    order = np.argsort(words)
    words, n, own_words = words[order], n[order], own_words[order]
    unit = np.full(len(words), -1, np.int32)
    picked = np.flatnonzero(own_words)
    unit[picked[np.lexsort((words[picked], -n[picked]))]] = np.arange(len(picked), dtype=np.int32)
    return Vocabulary(words, n, unit, len(picked), total, distinct, low)


def before_of(unit: np.ndarray, texts: np.ndarray, start: int) -> np.ndarray:
    """The units before units; ``start`` at the start of a text."""
    before = np.empty_like(unit)
    before[1:] = unit[:-1]
    before[np.concatenate(([True], texts[1:] != texts[:-1]))[: len(unit)]] = start
    return before


CODED = "row bigint, doc_id {}, learnt boolean, n_tokens bigint, known bigint, seen double, units binary, rare binary"


def coded(docs: DataFrame, shared) -> DataFrame:
    """A row for each of ``docs`` (doc_id, text, learnt): its tokens as units (clustered words, then lengths) and the words
    of those that are lengths, in order; known and seen count the words that are sent to all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, row = shared.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            hashes, shapes, of = tokens(batch.column(1))
            keys = key_of(hashes, shapes)
            at = v.find(keys)
            here = at >= 0
            unit = np.where(here, v.unit[at], -1) if len(v.unit) else np.full(len(at), -1)
            rare = unit < 0
            unit = np.where(rare, v.n_units + shapes, unit).astype(np.int32)
            logs = np.where(here, np.log10(v.counts[at] + 1.0), 0.0) if len(v.counts) else np.zeros(len(at))
            sizes = np.bincount(of, minlength=n)
            cuts = np.concatenate(([0], np.cumsum(sizes)))
            rare_cuts = np.concatenate(([0], np.cumsum(np.bincount(of[rare], minlength=n))))
            held = keys[rare]
            blobs = [pa.array([x[c[k] : c[k + 1]].tobytes() for k in range(n)], pa.binary()) for x, c in ((unit, cuts), (held, rare_cuts))]
            yield pa.RecordBatch.from_arrays([pa.array(row + np.arange(n)), batch.column(0), batch.column(2), pa.array(sizes), pa.array(np.bincount(of, here, minlength=n).astype(np.int64)), pa.array(np.bincount(of, logs, minlength=n)), *blobs], names=["row", "doc_id", "learnt", "n_tokens", "known", "seen", "units", "rare"])
            row += n

    small_batches(docs.sparkSession)
    return write_table(docs.select("doc_id", "text", "learnt").mapInArrow(tidied(run), CODED.format(docs.schema["doc_id"].dataType.simpleString())), "coded")


def unpacked(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(values, texts) of a batch's binary column."""
    parts = [np.frombuffer(x.as_buffer(), kind) for x in column]
    return np.concatenate(parts) if parts else np.zeros(0, kind), np.repeat(np.arange(len(parts)), [len(x) for x in parts])


def neighbours(rows: DataFrame, n_units: int) -> DataFrame:
    """A row for each slice of units: the counts of (unit, unit after) and of (unit, unit before), as sorted arrays."""

    def emit(pairs: Tally) -> Iterator[pa.RecordBatch]:
        pairs.merge()
        keys, counts = pairs.keys, pairs.counts
        left, right = keys >> 32, keys & 0xFFFFFFFF
        for side, key, slice_of in ((0, keys, left % SLICES), (1, right << 32 | left, right % SLICES)):
            order = np.argsort(slice_of, kind="stable")
            cuts = np.searchsorted(slice_of[order], np.arange(SLICES + 1))
            for low in range(0, SLICES, 32):
                rows = [(k, key[o].tobytes(), counts[o].astype("<i8").tobytes()) for k in range(low, min(SLICES, low + 32)) if len(o := order[cuts[k] : cuts[k + 1]])]
                if rows:
                    ks, a, b = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(ks, pa.int32()), pa.array([side] * len(ks), pa.int8()), pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["slice", "side", "keys", "counts"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = Tally()
        for batch in batches:
            if batch.num_rows:
                unit, of = unpacked(batch.column(0), "<i4")
                unit = unit.astype(np.int64)
                pairs.add(before_of(unit, of, n_units + len(LENGTHS) + 1) << 32 | unit)
                if len(pairs.keys) > FULL:
                    yield from emit(pairs)
                    pairs = Tally()
        yield from emit(pairs)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, [Tally(), Tally()]

        def done() -> pa.RecordBatch:
            cells = []
            for t in own:
                t.merge()
                cells += [pa.array([t.keys.tobytes()], pa.binary()), pa.array([t.counts.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array([held], pa.int32()), *cells], names=["slice", "after", "n_after", "before", "n_before"])

        for batch in batches:
            for k, side, keys, counts in zip(*batch.columns, strict=True):
                k = k.as_py()
                if k != held:
                    if held is not None:
                        yield done()
                    held, own = k, [Tally(), Tally()]
                own[side.as_py()].add(np.frombuffer(keys.as_buffer(), "<i8"), np.frombuffer(counts.as_buffer(), "<i8"))
        if held is not None:
            yield done()

    parts = rows.filter("learnt").select("units").mapInArrow(tidied(gather), "slice int, side tinyint, keys binary, counts binary")
    # rows are few and large: their tasks must not be merged
    placed = parts.repartition(min(SLICES, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "slice").sortWithinPartitions("slice")
    return write_table(placed.mapInArrow(tidied(join), "slice int, after binary, n_after binary, before binary, n_before binary"), "neighbours")


def log_of(x: np.ndarray) -> np.ndarray:
    """x ln x."""
    return x * np.log(np.maximum(x, 1e-300))


def profiles(keys, counts, k: int, n_units: int, classes: np.ndarray) -> np.ndarray:
    """Counts by unit of slice k and by class of its neighbours."""
    key, n = np.frombuffer(keys, "<i8"), np.frombuffer(counts, "<i8")
    rows = -(-(n_units - k) // SLICES) if n_units > k else 0
    at = (key >> 32) // SLICES * N_ALL + classes[key & 0xFFFFFFFF]
    return np.bincount(at, n, minlength=rows * N_ALL).reshape(-1, N_ALL)[:rows]


def exchange(slices: DataFrame, n_units: int) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(class of each unit, counts of class bigrams, likelihood at the start and after each turn)."""
    every = n_units + len(LENGTHS) + 2
    classes = np.concatenate((np.arange(n_units) % CLASSES, CLASSES + np.arange(len(LENGTHS) + 2))).astype(np.int64)

    def bigrams(classes: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = np.zeros((N_ALL, N_ALL))
            for batch in batches:
                for k, keys, counts in zip(*batch.columns, strict=True):
                    k = k.as_py()
                    by_unit = profiles(keys.as_buffer(), counts.as_buffer(), k, every, classes)
                    np.add.at(own, classes[np.arange(k, every, SLICES)], by_unit)
            yield pa.RecordBatch.from_arrays([pa.array([own.tobytes()], pa.binary())], names=["own"])

        rows = slices.select("slice", "after", "n_after").mapInArrow(tidied(run), "own binary").collect()  # a small matrix from each task
        return sum((np.frombuffer(r.own).reshape(N_ALL, N_ALL) for r in rows), np.zeros((N_ALL, N_ALL)))

    def likelihood(n: np.ndarray) -> float:
        return float(log_of(n).sum() - log_of(n.sum(0)).sum() - log_of(n.sum(1)).sum())

    def gains(classes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(best class, gain) of each unit, all others staying."""
        out_of, into = n.sum(1), n.sum(0)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k, after, n_after, before, n_before in zip(*batch.columns, strict=True):
                    k = k.as_py()
                    a, b = (profiles(x.as_buffer(), y.as_buffer(), k, every, classes) for x, y in ((after, n_after), (before, n_before)))
                    ids = np.arange(k, every, SLICES)
                    ids, a, b = ids[ids < n_units], a[: (ids < n_units).sum()], b[: (ids < n_units).sum()]
                    if not len(ids):
                        continue
                    own = classes[ids]
                    na, nb = a.sum(1), b.sum(1)
                    leave = log_of(n[own] - a).sum(1) - log_of(n[own]).sum(1) + log_of(n.T[own] - b).sum(1) - log_of(n.T[own]).sum(1) - log_of(out_of[own] - na) + log_of(out_of[own]) - log_of(into[own] - nb) + log_of(into[own])
                    enter = np.empty((len(ids), CLASSES))
                    for c in range(CLASSES):
                        enter[:, c] = log_of(n[c] + a).sum(1) - log_of(n[c]).sum() + log_of(n[:, c] + b).sum(1) - log_of(n[:, c]).sum() - log_of(out_of[c] + na) + log_of(out_of[c]) - log_of(into[c] + nb) + log_of(into[c])
                    enter[np.arange(len(ids)), own] = -leave
                    best = enter.argmax(1)
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(best), pa.array(enter[np.arange(len(ids)), best] + leave)], names=["unit", "best", "gain"])

        found = slices.mapInArrow(tidied(run), "unit bigint, best bigint, gain double").toArrow()  # at most CLUSTERED rows
        best, gain = classes[:n_units].copy(), np.zeros(n_units)
        at = found.column("unit").to_numpy()
        best[at], gain[at] = found.column("best").to_numpy(), found.column("gain").to_numpy()
        return best, gain

    n = bigrams(classes)
    now = likelihood(n)
    ids = np.arange(n_units, dtype=np.uint64)
    reached, quiet = [now], 0
    while quiet < QUIET and n_units > 1:
        best, gain = gains(classes, n)
        turn = len(reached)
        go = (gain > 1e-9) & (mix(ids) >> np.uint64(7) & np.uint64(1) == turn % 2)
        draw = mix(ids + np.full(n_units, turn, np.uint64) * _ODD)
        while go.any():
            moved = classes.copy()
            moved[:n_units][go] = best[go]
            fresh = bigrams(moved)
            if likelihood(fresh) > now:
                classes, n, now = moved, fresh, likelihood(fresh)
                break
            # a half of those that were to move
            go &= draw & np.uint64(1) == 0
            draw = draw >> np.uint64(1)
        quiet = quiet + 1 if now - reached[-1] < LEAST_GAIN * n.sum() else 0
        reached.append(now)
    return classes, n, reached


CLASSED = "word bigint, before tinyint, class tinyint, n bigint"


def rare_classes(rows: DataFrame, classes: np.ndarray, n_units: int, n: np.ndarray) -> DataFrame:
    """The class of every word that the exchange left out, as rows (word, null, class, n); and, as rows (null, before,
    class, n), how often such words of a class come after what is before them. In every task words are sorted."""
    table = np.log(n[:, :CLASSES] + ADDED) - np.log(n[:, :CLASSES].sum(0) + ADDED * N_ALL)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit, of = unpacked(batch.column(0), "<i4")
            words, _ = unpacked(batch.column(1), "<i8")
            before = classes[before_of(unit, of, n_units + len(LENGTHS) + 1)][unit >= n_units]
            order = np.lexsort((before, words))
            words, before = words[order], before[order]
            first = np.flatnonzero(np.concatenate(([True], (words[1:] != words[:-1]) | (before[1:] != before[:-1])))[: len(words)])
            yield pa.RecordBatch.from_arrays([pa.array(words[first]), pa.array(before[first], pa.int8()), pa.array(np.diff(first, append=len(words)).astype(np.int32))], names=["word", "before", "n"])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        after, held = np.zeros((N_ALL, CLASSES), np.int64), np.zeros((3, 0), np.int64)

        def out(of: np.ndarray) -> pa.RecordBatch:
            words, before, times = of
            first = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1]))[: len(words)])
            best = np.add.reduceat(table[before] * times[:, None], first).argmax(1) if len(first) else first
            np.add.at(after, (before, np.repeat(best, np.diff(first, append=len(words)))), times)
            total = np.add.reduceat(times, first) if len(first) else first
            return pa.RecordBatch.from_arrays([pa.array(words[first]), pa.nulls(len(first), pa.int8()), pa.array(best, pa.int8()), pa.array(total)], names=["word", "before", "class", "n"])

        for batch in batches:
            held = np.concatenate((held, np.stack([c.to_numpy().astype(np.int64) for c in batch.columns])), 1)
            if held.shape[1] > 1 << 15:
                cut = int(np.searchsorted(held[0], held[0, -1]))  # the last word may go on
                if cut:
                    yield out(held[:, :cut])
                    held = held[:, cut:]
        yield out(held)
        b, c = np.nonzero(after)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(b), pa.int64()), pa.array(b, pa.int8()), pa.array(c, pa.int8()), pa.array(after[b, c])], names=["word", "before", "class", "n"])

    seen = rows.filter("learnt").select("units", "rare").mapInArrow(tidied(gather), "word bigint, before tinyint, n int")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return write_table(seen.repartition(tasks, "word").sortWithinPartitions("word").mapInArrow(tidied(assign), CLASSED), "classes")


@dataclass
class Model:
    words: Vocabulary
    #: classes of units, lengths and the start; classes of the vocabulary's words
    classes: np.ndarray
    word_classes: np.ndarray
    #: log10 of the probability of a word, less log10(count + 1): by what is before and the word's class, NEW last
    log_after: np.ndarray
    log_base: float
    #: log likelihood of the exchange's classes at the start and after each turn
    reached: list[float]


def train(rows: DataFrame, v: Vocabulary) -> tuple[Model, DataFrame]:
    """The model of the rows that are learnt, and the classes of the words that the exchange left out."""
    slices = neighbours(rows, v.n_units)
    classes, n, reached = exchange(slices, v.n_units)
    drop_table(slices)
    rare = rare_classes(rows, classes, v.n_units, n)
    after = np.zeros((N_ALL, CLASSES + 1))
    after[:, :CLASSES] = n[:, :CLASSES]
    for r in rare.filter("word is null").groupBy("before", "class").agg(F.sum("n").alias("n")).collect():  # a small matrix
        after[r.before, r["class"]] += r.n
    # each class's counts plus one for each word
    mass = np.zeros(CLASSES + 1)
    own = np.flatnonzero(v.unit >= 0)
    word_classes = np.full(len(v.words), NEW)
    word_classes[own] = classes[v.unit[own]]
    np.add.at(mass, word_classes[own], v.counts[own] + 1)
    once = int((v.counts[own] == 1).sum())
    words = rare.filter("word is not null")
    for r in words.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("words"), F.count_if(F.col("n") == 1).alias("once")).collect():  # a row for each class
        mass[r["class"]] += r.n + r.words
        once += r.once
    sent = words.filter(level("n") >= v.low).select("word", "class").toArrow()  # at most COUNTED rows
    at = v.find(sent.column("word").to_numpy())
    word_classes[at[at >= 0]] = sent.column("class").to_numpy()[at >= 0]
    # new words: as often as words are seen once, and as many as there are known ones
    after[:, NEW] = after[:, :CLASSES].sum(1) * (once / max(1, v.total))
    mass[NEW] = v.distinct + 1
    shares = (after + ADDED) / (after.sum(1, keepdims=True) + ADDED * (CLASSES + 1))
    base = 1.0 / (v.total + v.distinct + 1)
    with np.errstate(divide="ignore"):
        per_class = np.where(mass > 0, 1.0 / np.maximum(mass, 1), 0.0)
    return Model(v, classes, word_classes, np.log10(SHARE * shares * per_class + (1 - SHARE) * base), float(np.log10(base)), reached), words


def score(rows: DataFrame, words: DataFrame, model: Model) -> DataFrame:
    """doc_id, learnt, n_tokens, n_known, base_score, score of every row that coded() gave."""
    spark = rows.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # bounded as its vocabulary is

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            unit, of = unpacked(batch.column(6), "<i4")
            keys, _ = unpacked(batch.column(7), "<i8")
            before = m.classes[before_of(unit, of, m.words.n_units + len(LENGTHS) + 1)]
            own = m.classes[unit]
            rare = np.flatnonzero(unit >= m.words.n_units)
            at = m.words.find(keys)
            own[rare] = np.where(at >= 0, m.word_classes[at], -1) if len(m.words.words) else -1
            known = own >= 0
            after = np.bincount(of[known], m.log_after[before[known], own[known]], minlength=n)
            left = rare[~known[rare]]
            words, b, o = keys[~known[rare]], before[left], of[left]
            order = np.lexsort((b, words, o))
            words, b, o = words[order], b[order], o[order]
            first = np.flatnonzero(np.concatenate(([True], (o[1:] != o[:-1]) | (words[1:] != words[:-1]) | (b[1:] != b[:-1])))[: len(o)])
            cuts = np.searchsorted(o[first], np.arange(n + 1)).astype(np.int32)
            found = pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays([pa.array(words[first]), pa.array(b[first], pa.int8()), pa.array(np.diff(first, append=len(o)))], names=["word", "before", "times"]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(after), found], names=["row", "doc_id", "learnt", "n_tokens", "known", "seen", "after", "rare"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    given = rows.select(*[c.split()[0] for c in CODED.split(", ")])
    found = write_table(given.mapInArrow(tidied(run), f"row bigint, doc_id {kind}, learnt boolean, n_tokens bigint, known bigint, seen double, after double, rare array<struct<word:bigint,before:tinyint,times:bigint>>"), "scored")
    rare = found.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.before", "r.times")
    logs = spark.createDataFrame([(b, c, float(x)) for b, line in enumerate(model.log_after) for c, x in enumerate(line)], "before tinyint, class tinyint, log double")  # a small matrix
    of = rare.join(words.select("word", "class", "n"), "word", "left").withColumn("class", F.coalesce("class", F.lit(NEW).cast("tinyint"))).join(F.broadcast(logs), ["before", "class"])
    own = F.log10(F.coalesce("n", F.lit(0)) + 1.0)
    more = of.groupBy("row").agg(F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("more_known"), F.sum(F.col("times") * own).alias("more_seen"), F.sum(F.col("times") * F.col("log")).alias("more_after"))
    every = found.drop("rare").join(more, "row", "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    seen = F.col("seen") + zero("more_seen")
    return every.select("doc_id", "learnt", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), (seen + F.col("n_tokens") * F.lit(model.log_base)).alias("base_score"), (seen + F.col("after") + zero("more_after")).alias("score"))


def score_documents(docs: DataFrame, held_out: int = 2, folds: int = 7) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every row of ``docs``
    (doc_id, text).

    Rows whose crc32 of the id's text modulo ``folds`` is ``held_out`` are scored only, all others are learnt from too.
    A null text is the empty text, one end; a null id counts as the empty id. Repeated rows count each. If nothing is
    learnt from, all words are new.
    """
    base = docs.select("doc_id", text_of("text").alias("text"), (id_hash_mod("doc_id", folds) != held_out).alias("learnt"))
    scored, total = learnt_and_scored(base)[:2]
    return scored.select("doc_id", (~F.col("learnt")).alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


def learnt_and_scored(base: DataFrame) -> tuple[DataFrame, int, Model, DataFrame]:
    """(scores, training tokens, model, classes of rare words) of rows (doc_id, text, learnt)."""
    counts = write_table(count_words(base.filter("learnt")), "words")
    v = vocabulary(counts)
    drop_table(counts)
    rows = coded(base, base.sparkSession.sparkContext.broadcast(v))  # at most COUNTED words
    model, words = train(rows, v)
    return score(rows, words, model), v.total, model, words
