"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line's own features and those of the lines before and after it give its state's score, and
neighbouring states have a score of their own. Forward and backward sums give each line's marginal probability of being
good; their mean, weighted by the lines' bytes, is the document's quality. The weights maximise the penalised likelihood
of labelled documents, all of whose lines have the document's label, each document's log likelihood divided by the root
of its lines. They are fitted on SAMPLE labelled documents at most, those with the smallest hashes of their ids, and on
every line of these. Their features stay a table: each evaluation of the likelihood and its slope is a job whose tasks
give one row of sums, and the ascent ends where no weight has a slope over TOLERANCE. Scoring covers every line of every
text.
"""

from __future__ import annotations

import math
import uuid
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import drop_table, id_hash_mod, small_batches, text_of, tidied, write_table
from ._text import raw, words

#: Labelled documents that the weights are fitted on, at most.
SAMPLE = 4000
DECAY = 1e-4
#: Slope of a weight at which the objective counts as being at its maximum.
TOLERANCE = 2e-5
#: Steps that the ascent remembers.
MEMORY = 12
#: Score from which a document is predicted to be good.
THRESHOLD = 0.3

# byte classes: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 full stop or comma, 6 other sentence marks, 7 bar,
# 8 symbols, 9 non-ASCII, 10 exclamation mark, 11 line end
CLASSES = 12
CLASS = np.zeros(256, np.int64)
CLASS[97:123], CLASS[65:91], CLASS[48:58], CLASS[[9, 11, 12, 13, 32]] = 1, 2, 3, 4
CLASS[[44, 46]], CLASS[[34, 39, 40, 41, 45, 58, 59, 63]], CLASS[124] = 5, 6, 7
CLASS[[35, 36, 37, 38, 42, 43, 47, 60, 61, 62, 64, 91, 92, 93, 94, 95, 96, 123, 125, 126]] = 8
CLASS[128:], CLASS[33], CLASS[10] = 9, 10, 11
OWN = 18


def lines_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, bytes, lines): a row for each line of all texts in order; each text's number of lines, 1 at least."""
    data, offsets = raw(texts)
    n_texts = len(offsets) - 1
    ends = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate((offsets[:-1], ends + 1)), kind="stable")  # empty texts have a line too
    of_end = np.searchsorted(offsets, ends, side="right") - 1
    lines = 1 + np.bincount(of_end, minlength=n_texts)
    # among equal starts the lines keep their order, as an empty line or text has no bytes
    n = len(starts)
    sizes = np.diff(starts, append=len(data))
    counts = np.zeros((n, CLASSES))
    for low in range(0, len(data), 1 << 21):
        part = data[low : low + (1 << 21)]
        a, b = np.searchsorted(starts, [low, low + len(part) - 1], side="right") - 1
        line = np.repeat(np.arange(a, b + 1), np.diff(np.clip(np.append(starts[a : b + 1], low + len(part)), low, None)))
        counts[a : b + 1] += np.bincount((line - a) * CLASSES + CLASS[part], minlength=(b - a + 1) * CLASSES).reshape(-1, CLASSES)
    hashes, _, places = words(data, offsets)
    of_word = np.searchsorted(starts, places, side="right") - 1
    n_words = np.bincount(of_word, minlength=n).astype(float)
    same = np.zeros(len(hashes))
    near = np.zeros(len(hashes))
    if len(hashes) > 1:
        same[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
        order = np.lexsort((hashes, of_word))
        near[1:] = (hashes[order][1:] == hashes[order][:-1]) & (of_word[order][1:] == of_word[order][:-1])
        repeated = np.bincount(of_word[order], near, minlength=n)
    else:
        repeated = np.zeros(n)
    own = sizes - counts[:, 11]
    some, worded = np.maximum(own, 1), np.maximum(n_words, 1)
    shares = counts[:, :11] / some[:, None]
    out = np.concatenate((shares, np.stack((np.log1p(own) / 5, np.log1p(n_words) / 3, own / worded / 10, np.bincount(of_word, same, minlength=n) / worded, repeated / worded, counts[:, 7] / worded, counts[:, 8] / worded), 1)), 1)
    return out, own, lines


def with_neighbours(own: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """A line's features, those of its neighbours in the same text, whether it has these, and 1."""
    n = len(own)
    last = np.cumsum(lines) - 1
    first = last - lines + 1
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    has_before, has_after = np.ones((n, 1)), np.ones((n, 1))
    before[first], has_before[first] = 0, 0
    after[last], has_after[last] = 0, 0
    return np.concatenate((own, before, after, has_before, has_after, np.ones((n, 1))), 1)


def columns_of(lines: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For k = 0, 1, ..: (rows, texts) of the k-th lines; texts with more lines come first."""
    order = np.argsort(-lines, kind="stable")
    first, sorted_lines = (np.cumsum(lines) - lines)[order], lines[order]
    k, n = 0, len(lines)
    while n:
        n = int(np.searchsorted(-sorted_lines, -k, side="left"))
        if n:
            yield first[:n] + k, order[:n]
        k += 1


def marginals(scores: np.ndarray, lines: np.ndarray, move: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """(marginals by line and state, expected transitions, log partition) for line scores and transition scores; the last
    two are sums over texts, each times its ``weight``."""
    steps = list(columns_of(lines))
    forward, backward = np.empty_like(scores), np.zeros_like(scores)
    for k, (rows, _) in enumerate(steps):
        forward[rows] = scores[rows]
        if k:
            held = forward[rows - 1]
            forward[rows] += np.logaddexp(held[:, :1] + move[0], held[:, 1:] + move[1])
    for rows, _ in reversed(steps[1:]):
        held = backward[rows] + scores[rows]
        backward[rows - 1] = np.logaddexp(held[:, :1] + move[:, 0], held[:, 1:] + move[:, 1])
    last = np.cumsum(lines) - 1
    total = np.logaddexp(forward[last, 0], forward[last, 1])
    of_line = np.repeat(total, lines)
    expected = np.zeros((2, 2))
    later = np.ones(len(scores), bool)
    later[last - lines + 1] = False
    at = np.flatnonzero(later)
    weight = np.ones(len(lines)) if weight is None else weight
    of_text = np.repeat(weight, lines)[at]
    for i in range(2):
        for j in range(2):
            expected[i, j] = np.exp(forward[at - 1, i] + move[i, j] + scores[at, j] + backward[at, j] - of_line[at]) @ of_text
    return np.exp(forward + backward - of_line[:, None]), expected, float(total @ weight)


class Model:
    """Weights of the good state (those of the bad state are 0), and transition scores from the state before (row)."""

    def __init__(self, weights: np.ndarray, move: np.ndarray, centre: np.ndarray, scale: np.ndarray):
        self.weights, self.move, self.centre, self.scale = weights, move, centre, scale

    def line_scores(self, own: np.ndarray, lines: np.ndarray) -> np.ndarray:
        good = with_neighbours((own - self.centre) / self.scale, lines) @ self.weights
        return np.stack((np.zeros(len(good)), good), 1)

    def good(self, own: np.ndarray, lines: np.ndarray) -> np.ndarray:
        return marginals(self.line_scores(own, lines), lines, self.move)[0][:, 1]

    def scores(self, texts: pa.Array) -> np.ndarray:
        own, sizes, lines = lines_of(texts)
        good = self.good(own, lines)
        weight = sizes + 1e-9  # texts of empty lines only: their plain mean
        first = np.cumsum(lines) - lines
        return np.clip(np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first), 0.0, 1.0)


def sums(theta: np.ndarray, x: np.ndarray, lines: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """(value, slope..) of the documents' log likelihoods, each divided by the root of its lines, summed. ``theta``: the
    weights, then the transition scores."""
    weight = 1 / np.sqrt(lines)
    y, move = np.repeat(labels, lines).astype(float), theta[-4:].reshape(2, 2)
    good = x @ theta[:-4]
    p, expected, partition = marginals(np.stack((np.zeros(len(good)), good), 1), lines, move, weight)
    by_line = np.repeat(weight, lines)
    seen = np.diag(np.bincount(labels.astype(np.int64), weight * (lines - 1), minlength=2))
    value = (y * good) @ by_line + (seen * move).sum() - partition
    return np.concatenate(([value], ((y - p[:, 1]) * by_line) @ x, (seen - expected).reshape(-1)))


def penalised(total: np.ndarray, n: int, theta: np.ndarray) -> tuple[float, np.ndarray]:
    """(value, slope) of what the fit maximises, from the sums over ``n`` documents: their mean, less DECAY / 2 times the
    weights' squares."""
    return float(total[0] / n - DECAY / 2 * (theta @ theta)), total[1:] / n - DECAY * theta


def objective(theta: np.ndarray, x: np.ndarray, lines: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray]:
    return penalised(sums(theta, x, lines, labels), len(lines), theta)


def maximise(evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], theta: np.ndarray) -> np.ndarray:
    """Where the concave function ``evaluate`` (value, slope) has no slope over TOLERANCE, by limited-memory quasi-Newton
    steps that are halved until they gain; or where no step gains any more, at the end of a double's digits."""
    value, slope = evaluate(theta)
    held: deque[tuple[np.ndarray, np.ndarray]] = deque(maxlen=MEMORY)  # steps, and how far the slope fell over them
    while np.abs(slope).max() > TOLERANCE:
        way, parts = slope.copy(), []
        for step, fall in reversed(held):
            parts.append(step @ way / (step @ fall))
            way -= parts[-1] * fall
        way *= held[-1][0] @ held[-1][1] / (held[-1][1] @ held[-1][1]) if held else 1 / max(1.0, np.abs(slope).sum())
        for step, fall in held:
            way += (parts.pop() - fall @ way / (step @ fall)) * step
        size = 1.0
        while True:
            there, slope_there = evaluate(theta + size * way)
            if there >= value + 1e-4 * size * (way @ slope):
                break
            size /= 2
            if size < 1e-9:
                return theta
        step, fall = size * way, slope - slope_there
        if step @ fall > 0:
            held.append((step, fall))
        theta, value, slope = theta + step, there, slope_there
    return theta


def read_sample(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, lines, labels) of rows of features_of()."""
    own = [np.frombuffer(x.as_buffer(), "<f4").reshape(-1, OWN) for x in batch.column(0)]
    return np.concatenate(own).astype(float), np.array([len(x) for x in own]), batch.column(1).to_numpy()


def summed(sample: DataFrame, of: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``of(features, lines, labels)`` over batches of the sample: a row for each task, added up exactly, so
    that the order in which tasks end does not show."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(*read_sample(batch))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["total"])

    rows = sample.mapInArrow(tidied(run), "total array<double>").collect()
    return np.array([math.fsum(x) for x in zip(*(r.total for r in rows), strict=True)])


def fit(sample: DataFrame) -> Model:
    """The maximum of the objective over all rows of features_of()."""

    def moments(own: np.ndarray, lines: np.ndarray, _: np.ndarray) -> np.ndarray:
        return np.concatenate(([len(lines), len(own)], own.sum(0), (own**2).sum(0)))

    found = summed(sample, moments)
    if not len(found):
        return Model(np.zeros(3 * OWN + 3), np.zeros((2, 2)), np.zeros(OWN), np.ones(OWN))
    n, centre = int(found[0]), found[2 : 2 + OWN] / found[1]
    scale = np.sqrt(np.maximum(found[2 + OWN :] / found[1] - centre**2, 0)) + 1e-3

    def evaluate(theta: np.ndarray) -> tuple[float, np.ndarray]:
        total = summed(sample, lambda own, lines, labels: sums(theta, with_neighbours((own - centre) / scale, lines), lines, labels))
        return penalised(total, n, theta)

    theta = maximise(evaluate, np.zeros(3 * OWN + 3 + 4))
    return Model(theta[:-4], theta[-4:].reshape(2, 2), centre, scale)


def features_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(features, quality): all lines of the labelled documents that are learnt from, a row each. Of an id with several
    texts the one of the smallest hash counts."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (id_hash_mod("doc_id", 5) != 0)).select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(SAMPLE)
    texts = docs.select("doc_id", text_of("text").alias("text")).join(F.broadcast(sample), "doc_id")  # at most SAMPLE rows

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own, _, lines = lines_of(batch.column(1))
            first = np.cumsum(lines) - lines
            data = [own[a : a + n].astype("<f4").tobytes() for a, n in zip(first, lines, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(data, pa.binary())], names=["doc_id", "quality", "tie", "features"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = texts.select("doc_id", "text", "quality", F.xxhash64("text").alias("tie")).mapInArrow(tidied(features), f"doc_id {kind}, quality int, tie bigint, features binary")
    return rows.groupBy("doc_id", "quality").agg(F.min(F.struct("tie", "features")).alias("least")).select("least.features", "quality")


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of labelled documents that are not held out (crc32 of the id's text modulo 5 is not 0). Labels whose id
    or quality is null teach nothing; of several different labels of an id all count."""
    small_batches(docs.sparkSession)
    sample = write_table(features_of(docs, labels), "features")
    model = fit(sample)
    drop_table(sample)
    return model


def score(docs: DataFrame, model: Model, keep: list[str], out: str = "score") -> DataFrame:
    """The columns ``keep`` of every row of ``docs`` and its score, named ``out``. A null text is the empty text, one
    empty line."""
    small_batches(docs.sparkSession)
    kept = [F.col(f"`{c}`") for c in keep]
    given = docs.select(text_of("text").alias(f"text_of_{out}"), *kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = model.scores(batch.column(0))
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, pa.float64())], names=[*keep, out])

    from pyspark.sql import types as T

    return given.mapInArrow(tidied(run), T.StructType([*[docs.schema[c] for c in keep], T.StructField(out, T.DoubleType())]))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text), learnt from ``labels`` (doc_id,
    quality). Only texts enter a score. Without labels every score is a half. Repeated rows are scored each."""
    scored = score(docs, learn(docs, labels), ["doc_id"])
    return scored.select("doc_id", (id_hash_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are predicted to be good, all columns."""
    names, mark = docs.columns, f"score_{uuid.uuid4().hex[:8]}"
    return score(docs, learn(docs, labels), names, mark).filter(F.col(mark) >= THRESHOLD).select(*[F.col(f"`{c}`") for c in names])
