"""Divergence of sources: how far the words of each source of a language lie from the other sources' and from the language's.

Two passes over whole texts. The first finds in how many documents each term of a language occurs, exactly; the language's
vocabulary is the terms in at least LEAST documents. The second counts their occurrences with an Aho-Corasick automaton: a
text's delimiters become spaces, and the automaton's patterns are the kept terms with a space on either side, so that a
match is an occurrence of a whole term. Texts fall into blocks of some megabytes, and the automaton of a block and language
holds the kept terms that the block's documents have, never the whole vocabulary: its size is bounded by the block's.

Terms fall into buckets by a hash, as many as the text needs for each to hold some hundred thousand entries. Terms and
counts of one block and bucket travel as one row, and tasks read a bucket's rows as a stream, holding its distinct terms alone.

Counts are sparse postings (language, bucket, source, terms by number in UTF-8 order, counts). A share is
p = 1 + floor(10^9 (n + 1) / (N + V)) for N occurrences in the group and V terms in the vocabulary, and the value of a term
against another share q is floor((p - q)^2 / q). A pair's sum over the whole vocabulary comes from three sparse parts: terms
of the one source and of the other, by histograms of their shares, as if the other source lacked them; terms of neither, all
alike; and a correction for each term of both, added up bucket by bucket.

Null text, lang and source are ''. Rows count as documents even if they repeat. A group without terms has all shares alike;
a language without a kept term gives pairs of value 0. Empty tables give no rows; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import drop_since, mark, small_batches, text_of, tidied, write_table
from ._text import raw

#: Documents of its language that a kept term is in, at least.
LEAST = 3
#: Ranks of the part ``term``.
TERMS = 200
#: Rows of a block, 2 to this power, of texts of up to PLAIN bytes; half as many for texts up to twice as long, and so on.
BLOCK, PLAIN = 11, 16_384
#: Counts that a task of the first pass holds before it gives them on.
HELD = 400_000
#: Bytes of text for each bucket of terms.
BUCKET = 16 << 20
#: Sources whose pairs are added up in a matrix; more are added up by sorting.
DENSE = 2048
#: Elements that are worked on at once.
CHUNK = 1 << 20

#: Bytes of a term: letters and all bytes of characters beyond ASCII; capitals become small, all others a space.
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

FOUND = "bucket int, lang string, block bigint, terms binary, df binary"
KEPT = "bucket int, lang string, terms binary, v bigint"
ASKED = "bucket int, lang string, block bigint, terms binary, ids binary"
COUNTED = "bucket int, lang string, sources array<string>, lengths array<int>, ids array<int>, counts array<int>"
POSTINGS = "bucket int, lang string, source string, ids array<int>, counts array<bigint>, size bigint, terms bigint"
VALUES = "kind string, lang string, a int, b int, term binary, value bigint, m bigint"

DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
w AS (SELECT i, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= 3),
vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT lang, term, sum(n)::BIGINT AS n FROM counts GROUP BY lang, term),
groups AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::BIGINT AS size FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN counts c ON g.lang = c.lang AND g.source = c.source GROUP BY g.lang, g.source),
shares AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.size + v) AS p
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN vocabulary y ON g.lang = y.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
whole AS (SELECT t.lang, t.term, 1 + (1000000000::HUGEINT * (t.n + 1)) // (s.size + v) AS q
  FROM totals t JOIN (SELECT lang, sum(size) AS size FROM groups GROUP BY lang) s ON t.lang = s.lang JOIN vocabulary y ON t.lang = y.lang),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::BIGINT AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT s.lang, s.source, 'term', s.term, (((p - q) * (p - q)) // q)::BIGINT FROM shares s JOIN whole w ON s.lang = w.lang AND s.term = w.term WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM parts)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def blocked(docs: DataFrame) -> DataFrame:
    """block, lang, source, text: the block follows from the row's place in its file. Documents that don't come straight
    from files are written first."""
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")] + [text_of().alias("text")]
    try:
        rows = docs.select(*columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
        rows.schema  # noqa: B018  is there such a column?
    except AnalysisException:
        rows = write_table(docs.select(*columns, F.lit("").alias("file"), F.monotonically_increasing_id().alias("at")), "divergence-docs")
    longer = F.ceil(F.log2(F.greatest(F.octet_length("text"), F.lit(1)) / PLAIN))
    power = F.least(F.lit(BLOCK), F.greatest(F.lit(0), BLOCK - longer)).cast("int")
    return rows.select(F.xxhash64("file", power, F.floor(F.col("at") / F.pow(F.lit(2.0), power)).cast("long")).alias("block"), "lang", "source", "text")


def folded(texts: pa.Array) -> Iterator[bytes]:
    """Texts as terms with spaces between."""
    data, at = raw(texts)
    plain = data.tobytes().translate(FOLDED)
    return (plain[low:high] for low, high in zip(at[:-1].tolist(), at[1:].tolist(), strict=True))


def packed(terms: list[bytes]) -> bytes:
    return zlib.compress(b" ".join(terms), 1)


def unpacked(terms: bytes) -> list[bytes]:
    return zlib.decompress(terms).split(b" ")


def packed_numbers(numbers: np.ndarray) -> bytes:
    return zlib.compress(numbers.astype("<u4").tobytes(), 1)


def unpacked_numbers(numbers: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(numbers), "<u4").astype(np.int64)


def batch_of(ddl: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64())}
    names, types = zip(*(c.split() for c in ddl.split(", ")), strict=True)
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], names=list(names))


def document_frequencies(rows: DataFrame, buckets: int) -> DataFrame:
    """bucket, lang, block, terms, df: in how many documents of a block each term of a bucket is. A block's terms may come
    in several rows, to be added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Counter] = defaultdict(Counter)

        def given() -> Iterator[pa.RecordBatch]:
            for (block, lang), found in held.items():
                terms = sorted(found)
                of = np.fromiter(map(zlib.crc32, terms), np.int64, len(terms)) % buckets
                order = np.argsort(of, kind="stable")
                edges = [0, *(np.flatnonzero(np.diff(of[order])) + 1).tolist(), len(order)]
                out = []
                for low, high in zip(edges[:-1], edges[1:], strict=True):
                    own = [terms[k] for k in order[low:high].tolist()]
                    if own:
                        out.append((int(of[order[low]]), lang, block, packed(own), packed_numbers(np.array([found[t] for t in own]))))
                yield batch_of(FOUND, out)
            held.clear()

        for b in batches:
            for block, lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), folded(b.column(2)), strict=True):
                held[block, lang].update(set(text.split()))
            if sum(map(len, held.values())) > HELD:
                yield from given()
        yield from given()

    return rows.select("block", "lang", "text").mapInArrow(tidied(run), FOUND)


def kept_terms(found: DataFrame) -> DataFrame:
    """bucket, lang, terms, v: the terms of a bucket in at least LEAST documents, in order, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, df = None, {}

        def given() -> Iterator[pa.RecordBatch]:
            kept = sorted(t for t, n in df.items() if n >= LEAST)
            if kept:
                yield batch_of(KEPT, [(*now, packed(kept), len(kept))])

        for b in batches:
            for bucket, lang, terms, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now != (bucket, lang):
                    yield from given()
                    now, df = (bucket, lang), {}
                for t, more in zip(unpacked(terms), unpacked_numbers(n).tolist(), strict=True):
                    df[t] = df.get(t, 0) + more
        yield from given()

    dealt = found.select("bucket", "lang", "terms", "df").repartition("bucket", "lang").sortWithinPartitions("bucket", "lang")
    return write_table(dealt.mapInArrow(tidied(run), KEPT), "kept-terms")


def vocabularies(found: DataFrame, kept: DataFrame) -> DataFrame:
    """bucket, lang, block, terms, ids: the kept terms that a block has, by their numbers in the bucket and language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, number = None, {}
        for b in batches:
            out = []
            for bucket, lang, block, terms, held in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held:
                    now, number = (bucket, lang), {t: k for k, t in enumerate(unpacked(terms))}
                elif now == (bucket, lang):
                    own = [t for t in unpacked(terms) if t in number]
                    if own:
                        out.append((bucket, lang, block, packed(own), packed_numbers(np.array([number[t] for t in own]))))
            yield batch_of(ASKED, out)

    known = kept.select("bucket", "lang", F.lit(None).cast("long").alias("block"), "terms", F.lit(True).alias("held"))
    both = known.unionByName(found.select("bucket", "lang", "block", "terms", F.lit(False).alias("held")))
    dealt = both.repartition("bucket", "lang").sortWithinPartitions("bucket", "lang", F.desc("held"))
    return dealt.mapInArrow(tidied(run), ASKED)


def occurrences(rows: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """bucket, lang, and for each source of a block how often the terms of its ``vocabulary`` occur in the block's rows."""
    import ahocorasick

    def count(docs: pa.Table, terms: pa.Table) -> pa.Table:
        places, mine, out = defaultdict(lambda: defaultdict(list)), defaultdict(list), []
        for k, (lang, source) in enumerate(zip(docs.column("lang").to_pylist(), docs.column("source").to_pylist(), strict=True)):
            places[lang][source].append(k)
        texts = list(folded(docs.column("text").combine_chunks())) if docs.num_rows else []
        for row in zip(*(terms.column(c).to_pylist() for c in ("lang", "bucket", "terms", "ids")), strict=True):
            mine[row[0]].append(row[1:])
        for lang in places.keys() & mine.keys():
            mine[lang].sort()
            automaton, size, buckets, ids = ahocorasick.Automaton(ahocorasick.STORE_INTS), 0, [], []
            for bucket, own, numbers in mine[lang]:
                for word in zlib.decompress(own).decode("latin-1").split(" "):
                    automaton.add_word(f" {word} ", size)
                    size += 1
                ids.append(unpacked_numbers(numbers))
                buckets.append(np.full(len(ids[-1]), bucket))
            automaton.make_automaton()
            ids, buckets = np.concatenate(ids), np.concatenate(buckets)
            parts = []
            for source, at in places[lang].items():
                matches = np.concatenate([np.fromiter((k for _, k in automaton.iter(f" {texts[p].decode('latin-1')} ")), np.int64) for p in at])
                parts.append((source, *np.unique(matches, return_counts=True)))
            del automaton
            of = np.concatenate([buckets[own] for _, own, _ in parts])
            source = np.repeat(np.arange(len(parts)), [len(own) for _, own, _ in parts])
            own, n = (np.concatenate([part[k] for part in parts]) for k in (1, 2))
            order = np.lexsort((source, of))
            edges = [0, *(np.flatnonzero(np.diff(of[order])) + 1).tolist(), len(order)]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                if low < high:
                    rows = order[low:high]
                    names, lengths = np.unique(source[rows], return_counts=True)
                    out.append((int(of[rows[0]]), lang, [parts[k][0] for k in names], lengths, ids[own[rows]], n[rows]))
        return pa.Table.from_batches([batch_of(COUNTED, out)])

    return rows.groupBy("block").cogroup(vocabulary.groupBy("block")).applyInArrow(count, COUNTED)


def added(pieces: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, counts) of pieces, each id once."""
    ids, at = np.unique(np.concatenate([i for i, _ in pieces]), return_inverse=True)
    counts = np.zeros(len(ids), np.int64)
    np.add.at(counts, at, np.concatenate([n for _, n in pieces]))
    return ids, counts


def postings_of(counted: DataFrame) -> DataFrame:
    """bucket, lang, source, ids, counts, size (all occurrences), terms (how many there are); written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, defaultdict(list)

        def given() -> Iterator[pa.RecordBatch]:
            rows = []
            for source, pieces in held.items():
                ids, n = added(pieces)
                rows.append((*now, source, ids, n, int(n.sum()), len(ids)))
            for k in range(0, len(rows), 256):
                yield batch_of(POSTINGS, rows[k : k + 256])
            held.clear()

        for b in batches:
            bucket, lang, sources, lengths = (b.column(k).to_pylist() for k in range(4))
            for k in range(b.num_rows):
                if now != (bucket[k], lang[k]):
                    yield from given()
                    now = bucket[k], lang[k]
                ids, counts = (b.column(c)[k].values.to_numpy() for c in (4, 5))
                ends = np.cumsum(lengths[k])[:-1]
                for source, i, n in zip(sources[k], np.split(ids, ends), np.split(counts, ends), strict=True):
                    held[source].append((i, n))
                    if len(held[source]) > 64:
                        held[source] = [added(held[source])]
        yield from given()

    dealt = counted.repartition("bucket", "lang").sortWithinPartitions("bucket", "lang")
    return write_table(dealt.mapInArrow(tidied(run), POSTINGS), "term-postings")


def shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (n + 1) / total), whatever the numbers' sizes."""
    if len(n) and int(n.max()) > 9_000_000_000:
        return (1 + 10**9 * (n.astype(object) + 1) // total.astype(object)).astype(np.int64)
    return 1 + 10**9 * (n + 1) // total


def against(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def corrections(ids: np.ndarray, number: np.ndarray, p: np.ndarray, p0: np.ndarray, sources: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, sums over the terms of both of the true value less what the histograms give). Rows are in the order of ids."""
    sums = np.zeros((sources, sources), np.int64) if sources <= DENSE else None
    starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, np.int64)
    lengths = np.diff(np.append(starts, len(ids)))
    for length in np.unique(lengths[lengths > 1]).tolist():
        firsts = starts[lengths == length]
        # the sources of a term by themselves, or in slices where they are very many
        step, slice_ = max(1, CHUNK // length**2), max(1, min(length, CHUNK // length))
        for k in range(0, len(firsts), step):
            all_ = firsts[k : k + step, None] + np.arange(length)
            for low in range(0, length, slice_):
                one, two = all_[:, low : low + slice_, None], all_[:, None, :]
                extra = against(p[one], p[two]) - against(p[one], p0[two]) - against(p0[one], p[two]) + against(p0[one], p0[two])
                a, b = (np.broadcast_to(number[x], extra.shape).ravel() for x in (one, two))
                if sums is not None:
                    np.add.at(sums, (a, b), extra.ravel())
                    continue
                pairs, at = np.unique(a.astype(np.int64) * sources + b, return_inverse=True)
                own = np.zeros(len(pairs), np.int64)
                np.add.at(own, at.ravel(), extra.ravel())
                yield pairs // sources, pairs % sources, own
    if sums is not None:
        a, b = np.nonzero(sums)
        yield a, b, sums[a, b]


def values_of(postings: DataFrame, kept: DataFrame) -> DataFrame:
    """What a bucket gives, by kind: ``term`` (a, term, value: the best of each source), ``pair`` (a, b, value: corrections)
    and ``count`` (a, value: a share, m: how many of a's terms have it). ``postings`` have number, last, size, lang_size, v
    and p0 of their source."""

    def run(rows: pa.Table, terms: pa.Table) -> pa.Table:
        batches: list[pa.RecordBatch] = []
        if not rows.num_rows:
            return pa.Table.from_batches([batch_of(VALUES, [])])
        lang, words = rows.column("lang")[0].as_py(), unpacked(terms.column("terms")[0].as_py())
        lists = [x.values.to_numpy() for x in rows.column("ids")]
        lengths = [len(x) for x in lists]
        each = lambda c: np.repeat(rows.column(c).to_numpy(), lengths)
        ids, n = np.concatenate(lists).astype(np.int64), np.concatenate([x.values.to_numpy() for x in rows.column("counts")])
        order = np.argsort(ids, kind="stable")
        ids, n = ids[order], n[order]
        number, p0, v = each("number")[order], each("p0")[order], each("v")[order]
        p = shares(n, each("size")[order] + v)
        total = np.zeros(len(words), np.int64)
        np.add.at(total, ids, n)
        q = shares(total[ids], each("lang_size")[order] + v)

        def give(kind: str, a, b=None, term=None, value=None, m=None) -> None:
            k = len(a)
            none = lambda x, t: pa.nulls(k, t) if x is None else pa.array(x, t)
            columns = [pa.array([kind] * k, pa.string()), pa.array([lang] * k, pa.string()), none(a, pa.int32()), none(b, pa.int32()), none(term, pa.binary()), none(value, pa.int64()), none(m, pa.int64())]
            batches.append(pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in VALUES.split(", ")]))

        over = np.flatnonzero(p > q)
        far = against(p[over], q[over])
        # ids are in the order of terms, so that ties go to the least term
        best = np.lexsort((ids[over], -far, number[over]))
        own = number[over][best]
        rank = np.arange(len(own)) - np.searchsorted(own, own)
        best = best[rank < TERMS]
        give("term", number[over][best], term=[words[k] for k in ids[over][best].tolist()], value=far[best])
        by = np.lexsort((p, number))
        fresh = np.flatnonzero(np.concatenate([[True], (np.diff(number[by]) != 0) | (np.diff(p[by]) != 0)]))
        give("count", number[by][fresh], value=p[by][fresh], m=np.diff(np.append(fresh, len(by))))
        for a, b, extra in corrections(ids, number, p, p0, rows.column("last")[0].as_py() + 1):
            give("pair", a[a != b], b=b[a != b], value=extra[a != b])
        return pa.Table.from_batches(batches)

    return write_table(postings.groupBy("lang", "bucket").cogroup(kept.groupBy("lang", "bucket")).applyInArrow(run, VALUES), "divergence-values")


def share(n: str, of: str = "size") -> Column:
    """As shares(), in SQL."""
    return F.expr(f"1 + CAST(1000000000 AS DECIMAL(19,0)) * CAST({n} + 1 AS DECIMAL(19,0)) div CAST(greatest({of} + v, 1) AS DECIMAL(19,0))")


def value(p: str, q: str) -> Column:
    """floor((p - q)^2 / q); shares are 10^9 + 1 at most, so that squares stay in 64 bits."""
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def ranked(rows: DataFrame, part: str, item: str) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), item)
    return rows.select("lang", "source", F.lit(part).alias("part"), item, "value", F.row_number().over(order).alias("rank"))


def pair_values(values: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value for each two sources of a language. ``groups``: lang, source, number, terms, v, p0."""
    counts = values.filter("kind = 'count'").groupBy("lang", F.col("a").alias("number"), F.col("value").alias("p")).agg(F.sum("m").alias("m"))
    extra = values.filter("kind = 'pair'").groupBy("lang", "a", "b").agg(F.sum("value").alias("extra"))
    others = groups.select("lang", F.col("number").alias("other"), F.col("p0").alias("other_p0"))
    met = counts.join(others, "lang").filter("number <> other")
    alone = met.groupBy("lang", F.col("number").alias("a"), F.col("other").alias("b")).agg(F.sum(F.col("m") * value("p", "other_p0")).alias("forth"), F.sum(F.col("m") * value("other_p0", "p")).alias("back"))
    forth, back = alone.select("lang", "a", "b", "forth"), alone.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "back")
    one = groups.select("lang", F.col("number").alias("a"), "source", "v", F.col("terms").alias("a_terms"), F.col("p0").alias("a_p0"))
    two = groups.select("lang", F.col("number").alias("b"), F.col("source").alias("item"), F.col("terms").alias("b_terms"), F.col("p0").alias("b_p0"))
    pairs = one.join(two, "lang").filter("a <> b")
    for part in (forth, back, extra):
        pairs = pairs.join(part, ["lang", "a", "b"], "left")
    known = lambda c: F.coalesce(F.col(c), F.lit(0))
    neither = (F.col("v") - F.col("a_terms") - F.col("b_terms")) * value("a_p0", "b_p0")
    return pairs.select("lang", "source", "item", (known("forth") + known("back") + known("extra") + neither).alias("value"))


def audit(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank of ``docs`` (text, lang, source)."""
    spark, start = docs.sparkSession, mark()
    small_batches(spark)
    rows = blocked(docs)
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    found = write_table(document_frequencies(rows, 1 + size // BUCKET), "term-frequencies")
    kept = kept_terms(found)
    postings = postings_of(occurrences(rows, vocabularies(found, kept)))

    sizes = postings.groupBy("lang", "source").agg(F.sum("size").alias("size"), F.sum("terms").alias("terms"))
    kinds = kept.groupBy("lang").agg(F.sum("v").alias("v"))
    groups = rows.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(kinds, "lang", "left").na.fill(0, ["size", "terms", "v"])
    of_lang = W.partitionBy("lang")  # a row a source
    groups = groups.withColumn("number", (F.row_number().over(of_lang.orderBy("source")) - 1).cast("int")).withColumn("last", F.max("number").over(of_lang))
    groups = write_table(groups.withColumn("lang_size", F.sum("size").over(of_lang)).withColumn("p0", share("0")), "divergence-groups")

    known = postings.select("bucket", "lang", "source", "ids", "counts").join(groups.drop("terms"), ["lang", "source"]).drop("source")
    values = values_of(known, kept)
    names = groups.select("lang", F.col("number").alias("a"), "source")
    terms = ranked(values.filter("kind = 'term'").join(names, ["lang", "a"]), "term", "term").filter(F.col("rank") <= TERMS)
    out = ranked(pair_values(values, groups), "pair", "item").unionByName(terms.withColumn("item", F.col("term").cast("string")).drop("term"))
    drop_since(spark, start, values, groups)
    return out.select("lang", "source", "part", "item", "value", "rank")
