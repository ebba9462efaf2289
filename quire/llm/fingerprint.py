"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A text is cut into paragraphs where its content says so: at line ends, and after words (between spaces) whose hash ends
in zero bits, one in CUT. So a change moves no cut but those near it, and all texts are cut alike, whatever their length.
Every distinct paragraph's 64-bit digest is added to three cells, one in each of three subtables; a cell holds a count,
the xor of its digests and the xor of their checks. The cells of two versions subtract: what both hold cancels out.
Peeling takes a cell with a single digest, notes it and removes it from its other cells, until all are empty. When cells
remain, larger sketches are built and subtracted: digests are dealt by their bits into groups of about GROUP, so that
the work stays near linear in the paragraphs, and a group that does not peel is tried again with more cells. A group that
resists all of these (three digests with equal places at every size) is compared exactly.

The likeness of two texts with paragraph sets A and B is 1 - |A xor B| / (|A| + |B|), with A xor B the digests recovered;
two empty texts are alike.

Only built-in functions are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import text_of

#: Words of a paragraph, about; a power of two.
CUT = 16
#: Cells in a subtable of the fingerprint itself.
SMALL = 4
#: Cells in a subtable of a group's sketch, in its attempts.
LARGER = (8, 16, 64)
#: Digests of both versions that a group holds, about.
GROUP = 4
#: Rounds of peeling; each takes all cells that hold one digest.
ROUNDS = 16
#: Characters in a bucket of neighbouring documents, about, and buckets at most.
BUCKET_CHARS, MOST_BUCKETS = 8 << 20, 1 << 16
#: Quantiles of the ids that buckets are cut by.
QUANTILES = 256


def paragraphs(text: Column) -> Column:
    """Distinct digests of a text's paragraphs."""
    ends = lambda w: F.xxhash64(w).bitwiseAND(F.lit(CUT - 1)) == 0
    marked = F.array_join(F.transform(F.split(text, " "), lambda w: F.when(ends(w), F.concat(w, F.lit("\n"))).otherwise(w)), " ")
    pieces = F.filter(F.transform(F.split(marked, "\n"), lambda p: F.trim(p)), lambda p: p != "")
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p)))


def check_of(digest: Column) -> Column:
    return F.xxhash64(digest).bitwiseAND(F.lit(0xFFFFFFFF))


def places(size: int) -> Column:
    """The cells of three subtables of ``size`` cells, a power of two up to 64: a digest belongs into the cells whose bits
    ``at`` it has under ``mask``."""
    one = lambda shift, i: f"named_struct('mask', {(size - 1) << shift}L, 'at', {i << shift}L)"
    return F.expr("array(" + ", ".join(one(2 + 6 * j, i) for j in range(3) for i in range(size)) + ")")


def cell(count: Column, digest: Column, check: Column) -> Column:
    return F.struct(count.alias("n"), digest.alias("d"), check.alias("c"))


def none_yet() -> Column:
    return cell(F.lit(0), F.lit(0).cast("long"), F.lit(0).cast("long"))


def sketch(digests: Column, size: int) -> Column:
    """An array of 3 * size cells."""
    add = lambda a, d: cell(a["n"] + 1, a["d"].bitwiseXOR(d), a["c"].bitwiseXOR(check_of(d)))
    return F.transform(places(size), lambda p: F.aggregate(F.filter(digests, lambda d: d.bitwiseAND(p["mask"]) == p["at"]), none_yet(), add))


def subtract(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda x, y: cell(x["n"] - y["n"], x["d"].bitwiseXOR(y["d"]), x["c"].bitwiseXOR(y["c"])))


def with_name(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def peeled(cells: Column, size: int) -> Column:
    """The digests that peeling recovers from subtracted cells; null if cells remain.

    ``left`` is the sum of all digests that are still in the cells; peeling is over when it is empty."""
    less = lambda c, parts: F.aggregate(parts, c, lambda a, p: cell(a["n"] - p["n"], a["d"].bitwiseXOR(p["d"]), a["c"].bitwiseXOR(p["c"])))
    plus = lambda a, p: cell(a["n"] + p["n"], a["d"].bitwiseXOR(p["d"]), a["c"].bitwiseXOR(p["c"]))
    empty = lambda c: (c["n"] == 0) & (c["d"] == 0) & (c["c"] == 0)

    def state(cells: Column, left: Column, all_: Column, over: Column) -> Column:
        return F.struct(cells.alias("cells"), left.alias("left"), all_.alias("all"), over.alias("over"))

    def begin(c: Column) -> Column:
        left = F.aggregate(F.slice(c, 1, size), none_yet(), plus)
        return with_name(left, lambda x: state(c, x, F.array().cast("array<bigint>"), empty(x)))

    def turn(s: Column, _: Column) -> Column:
        found = F.array_distinct(F.filter(s["cells"], lambda c: (F.abs(c["n"]) == 1) & (c["c"] == check_of(c["d"]))))
        there = lambda p: lambda f: f["d"].bitwiseAND(p["mask"]) == p["at"]
        without = lambda f: F.zip_with(s["cells"], places(size), lambda c, p: less(c, F.filter(f, there(p))))

        def take(x: Column) -> Column:
            over = empty(x["left"]) | (F.size(x["found"]) == 0)
            rest = F.when(over, s["cells"]).otherwise(without(x["found"]))
            return state(rest, x["left"], F.concat(s["all"], F.transform(x["found"], lambda f: f["d"])), over)

        step = with_name(found, lambda f: with_name(F.struct(f.alias("found"), less(s["left"], f).alias("left")), take))
        return F.when(s["over"], s).otherwise(step)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), with_name(cells, begin), turn, lambda s: F.when(empty(s["left"]), s["all"]))


def differing(a: Column, b: Column) -> Column:
    """The digests in one of two sets only, by grouped sketches that grow until they peel."""
    groups = F.greatest(F.lit(1), F.ceil((F.size(a) + F.size(b)) / GROUP))
    way = F.ceil(F.sqrt(groups.cast("double"))).cast("long")
    in_group = lambda shift, n, g: lambda d: F.pmod(F.shiftright(d, shift), n) == g
    split = lambda of, shift, n: F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda g: F.struct(F.filter(of["a"], in_group(shift, n, g)).alias("a"), F.filter(of["b"], in_group(shift, n, g)).alias("b")))
    fine = with_name(F.struct(a.alias("a"), b.alias("b"), way.alias("way")), lambda x: F.flatten(F.transform(split(x, 24, x["way"]), lambda y: split(y, 43, x["way"]))))

    def of_group(g: Column) -> Column:
        exact = F.concat(F.array_except(g["a"], g["b"]), F.array_except(g["b"], g["a"]))
        tries = [peeled(subtract(sketch(g["a"], n), sketch(g["b"], n)), n) for n in LARGER]
        return F.when((F.size(g["a"]) == 0) & (F.size(g["b"]) == 0), F.array().cast("array<bigint>")).otherwise(F.coalesce(*tries, exact))

    return F.flatten(F.transform(fine, of_group))


def recovered(a: Column, b: Column, cells_a: Column, cells_b: Column) -> Column:
    """The digests of the paragraphs in one of two texts only: subtracts the fingerprints and peels them; where that fails,
    larger sketches of the paragraphs ``a`` and ``b``."""
    return F.coalesce(peeled(subtract(cells_a, cells_b), SMALL), differing(a, b))


def likeness(a: Column, b: Column, cells_a: Column, cells_b: Column) -> Column:
    total = F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(1.0 - F.size(recovered(a, b, cells_a, cells_b)) / total)


def as_text(cells: Column) -> Column:
    """Count, digest and check of each cell in fixed-width hexadecimal."""
    wide = lambda x, n: F.lpad(F.lower(F.hex(x)), n, "0")
    return F.array_join(F.transform(cells, lambda c: F.concat(wide(c["n"], 8), wide(c["d"], 16), wide(c["c"], 8))), "")


def numbers(values: list[int]) -> Column:
    """A constant array, made in one call to the JVM."""
    return F.expr("array(" + ", ".join(f"{v}L" for v in values) + ")")


def with_next(docs: DataFrame, names: list[str]) -> DataFrame:
    """Adds ``next``, a struct of ``names`` of the next row in ascending doc_id order (after the last, the first).

    Rows are dealt into buckets of neighbouring ids of about equal characters, and each bucket also gets the first row
    of the one after it; so one shuffle, and no window over the whole table. Ids are cut at quantiles; neighbouring cuts
    with few characters share a bucket, and those with many are cut evenly. Null ids come first, in buckets by ``tie``,
    and rows of equal id in the order of ``tie``.
    """
    spark = docs.sparkSession
    cuts_of = F.percentile_approx("doc_id", [k / QUANTILES for k in range(1, QUANTILES)], 100_000)
    facts = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), cuts_of.alias("cuts")).first()
    low, high = facts.low or 0, facts.high or 0
    cuts = sorted({low, *(facts.cuts or [])})
    starts = numbers(cuts)
    k = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(F.size(F.filter(starts, lambda c: c <= F.col("doc_id"))))
    held = {r.k: r.chars for r in docs.groupBy(k.alias("k")).agg(F.sum(F.col("n_chars") + 1).alias("chars")).collect()}  # a row for each cut
    each = max(BUCKET_CHARS, -(-sum(held.values()) // MOST_BUCKETS))
    parts = {c: max(1, -(-n // each)) for c, n in held.items()}
    first, at, room = {}, 0, 0
    for c in sorted(held):  # a cut of one part shares a bucket while there is room
        if parts[c] > 1 or held[c] > room:
            first[c], at, room = at, at + parts[c], each - held[c] if parts[c] == 1 else 0
        else:
            first[c], room = at - 1, room - held[c]
    cuts_held = range(len(cuts) + 1)
    of = lambda d, none: F.element_at(numbers([d.get(c, none) for c in cuts_held]), k + 1)
    n, begin = of(parts, 1), F.element_at(numbers([low, *cuts]), k + 1)
    wide = F.element_at(numbers([high + 1, *cuts[1:], high + 1]), k + 1) - begin
    share = F.when(F.col("doc_id").isNull(), F.col("tie") / F.lit(2.0**64) + 0.5).otherwise((F.col("doc_id") - begin) / wide)
    rows = docs.withColumn("bucket", of(first, 0) + F.least(n - 1, F.floor(share * n)))
    rows = rows.withColumn("bucket", F.col("bucket").cast("long"))
    # a row for each bucket, MOST_BUCKETS + QUANTILES at most
    order = F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "tie")
    heads = [(r.bucket, r.head.doc_id, r.head.tie) for r in rows.groupBy("bucket").agg(F.min(order).alias("head")).orderBy("bucket").collect()]
    guests = [(doc_id, tie, heads[i - 1][0]) for i, (_, doc_id, tie) in enumerate(heads)]
    table = F.broadcast(spark.createDataFrame(guests, "head bigint, head_tie bigint, to bigint"))
    again = docs.join(table, F.col("doc_id").eqNullSafe(F.col("head")) & (F.col("tie") == F.col("head_tie"))).drop("head", "head_tie").withColumnRenamed("to", "bucket").withColumn("guest", F.lit(1))
    both = rows.withColumn("guest", F.lit(0)).unionByName(again)
    w = W.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_first(), "tie")
    return both.withColumn("next", F.lead(F.struct(*names)).over(w)).filter("guest = 0").drop("bucket", "guest")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The edited text swaps the last floor(n_chars / 2) code points for the first as many (or all) of the next
    document's. A null text is the empty text, whose fingerprint has empty cells only. A single document is its own
    next. Other columns are not read. Equal texts have equal fingerprints.
    """
    text = F.col("text")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")).withColumn("n_chars", F.length(text).cast("long"))
    base = base.withColumn("tie", F.xxhash64(text))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    both = with_next(base.withColumn("own", paragraphs(text)), ["text", "own"])
    edited = F.concat(text.substr(F.lit(1), F.col("n_chars").cast("int") - half), F.col("next.text").substr(F.lit(1), half))
    rows = both.withColumn("edited_text", edited)
    rows = rows.select("doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"), "own", paragraphs(F.col("edited_text")).alias("edited"), F.col("next.own").alias("other"))
    cells = rows.select("*", *[sketch(F.col(c), SMALL).alias(f"{c}_cells") for c in ("own", "edited", "other")])
    near = lambda c: likeness(F.col("own"), F.col(c), F.col("own_cells"), F.col(f"{c}_cells"))
    return cells.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("own_cells")).alias("fingerprint"), as_text(F.col("edited_cells")).alias("edited_fingerprint"), near("edited").alias("near_edited"), near("other").alias("near_next"))
