"""Ordered streams without a global window.

Numbers, running sums and as-of assignments over a whole stream are split in two: within parts of the stream (pages,
chapters, bins of an offset), which are many and spread over tasks, and over the parts' totals, one row for each part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def ordinal(df: DataFrame, keys: list[str], order: list, out: str) -> DataFrame:
    """Adds 1, 2, .. within ``keys`` in the full ``order``."""
    return df.withColumn(out, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))


def running(value: Column, keys: list[str], order: list, before: bool = False) -> Column:
    """Running sum within ``keys``, of the rows before the current one if ``before``."""
    frame = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1 if before else 0)
    total = F.sum(value).over(frame)
    return F.coalesce(total, F.lit(0).cast("long")) if before else total


def prefix_sum(df: DataFrame, value: Column, keys: list[str], part: str, order: list, out: str, before: bool = True) -> DataFrame:
    """Running sum over the stream of ``keys``, which is ordered by ``part`` and within it by ``order``. Rows are made twice, for
    the totals and for the sums, and keep what they are dealt by; for dear rows see prefix_sums."""
    rows = df.withColumn("_value", value.cast("long"))
    totals = rows.groupBy(*keys, part).agg(F.sum("_value").alias("_total"))
    ahead = W.partitionBy(*keys).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(*keys, F.col(part).alias("_of_part"), F.coalesce(F.sum("_total").over(ahead), F.lit(0)).alias("_ahead"))
    joined = rows.join(offsets.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)}), [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col(part).eqNullSafe(F.col("_of_part"))])
    own = running(F.col("_value"), [*keys, part], order, before)
    return joined.withColumn(out, F.col("_ahead") + own).drop("_value", "_of_part", "_ahead", *[f"_k{i}" for i in range(len(keys))])


def stream_part(keys: list[str], part: str) -> Column:
    """A part of a stream as one value, ``_stream`` of prefix_sums: a struct, as nulls in it equal each other."""
    return F.struct(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col(part).alias("_part_no")).alias("_stream")


def prefix_sums(df: DataFrame, values: dict[str, Column], keys: list[str], part: str, order: list, before: bool = True, ties: bool = True) -> DataFrame:
    """Running sums over the stream of ``keys``, which is ordered by ``part`` and within it by ``order``; ties go by the
    other columns, unless there are none. Rows that are already dealt by a column ``_stream`` (of stream_part, in place of
    ``keys`` and ``part``) stay where they are.

    Rows are made once and dealt by part once: a part's totals are its last row's sums, so that they ask for the same
    columns of the same exchange as the rows themselves, and both meet where they are.
    """
    named = {c for c in order if isinstance(c, str)} | {*keys, part, "_stream"}
    others = [f.name for f in df.schema.fields if ties and f.name not in named and not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    n = range(len(values))
    keyed = {k: F.col(f"_stream._key{i}") for i, k in enumerate(keys)} | {part: F.col("_stream._part_no")}
    bare = [F.col(f"`{c}`") for c in df.columns if c not in keyed and c != "_stream"]
    rows = df.select("*", *[] if "_stream" in df.columns else [stream_part(keys, part)])
    rows = rows.select(*bare, "_stream", *[v.cast("long").alias(f"_value{i}") for i, v in enumerate(values.values())])
    inside = W.partitionBy("_stream").orderBy(*order, *others)
    upto = rows.select("*", F.row_number().over(inside).alias("_row"), *[F.sum(f"_value{i}").over(inside.rowsBetween(W.unboundedPreceding, 0)).alias(f"_upto{i}") for i in n])
    totals = upto.groupBy("_stream").agg(*[F.max_by(f"_upto{i}", "_row").alias(f"_total{i}") for i in n])
    ahead = W.partitionBy(*[f"_stream._key{i}" for i in range(len(keys))]).orderBy("_stream._part_no").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("_stream", *[F.coalesce(F.sum(f"_total{i}").over(ahead), F.lit(0)).alias(f"_ahead{i}") for i in n])
    own = lambda i: F.coalesce(F.col(f"_upto{i}") - F.coalesce(f"_value{i}", F.lit(0)), F.lit(0)) if before else F.col(f"_upto{i}")
    kept = [keyed.get(c, F.col(f"`{c}`")).alias(c) for c in dict.fromkeys([*df.columns, *keyed]) if c not in values and c != "_stream"]
    return upto.join(offsets, "_stream").select(*kept, *[(F.col(f"_ahead{i}") + own(i)).alias(out) for i, out in enumerate(values)])


def previous(df: DataFrame, value: Column, keys: list[str], part: str, order: list[str], out: str) -> DataFrame:
    """Adds the ``value`` of the row before in the stream of ``keys``, which is ordered by ``part`` and within it by
    ``order``; null for the first row. A window runs over a part, and one over the parts' last values."""
    rows = df.withColumn("_value", value)
    lasts = rows.groupBy(*keys, part).agg(F.max_by(F.struct("_value"), F.struct(*order)).alias("_last"))
    carry = lasts.withColumn("_carry", F.lag("_last").over(W.partitionBy(*keys).orderBy(part))).select(*keys, part, "_carry")
    own = W.partitionBy(*keys, part).orderBy(*order)
    both = rows.withColumn("_own", F.lag(F.struct("_value")).over(own)).join(carry, [*keys, part])
    return both.withColumn(out, F.coalesce("_own", "_carry")["_value"]).drop("_value", "_own", "_carry")


def assign_by_offset(points: DataFrame, starts: DataFrame, keys: list[str], at: str, start: str, payload: list[str], width: int = 65_536) -> DataFrame:
    """Adds to each point the ``payload`` of the last start at or before its offset ``at`` (an as-of join).

    Both sides fall into bins of ``width`` offsets. Within a bin the last start before a point is a window's last
    value; a point before its bin's first start takes the last start of the bins before. Starts of equal offset: the
    greatest ``payload`` wins. Points before all starts get nulls.
    """
    kept = F.struct(*payload)
    bin_of = lambda c: F.floor(F.col(c) / width)
    marks = starts.select(*keys, bin_of(start).alias("_bin"), F.col(start).alias("_at"), kept.alias("_start"))
    rows = points.withColumn("_bin", bin_of(at)).withColumn("_at", F.col(at)).withColumn("_start", F.lit(None).cast(marks.schema["_start"].dataType)).withColumn("_point", F.lit(1))
    both = rows.unionByName(marks.withColumn("_point", F.lit(0)), allowMissingColumns=True)
    inside = W.partitionBy(*keys, "_bin").orderBy("_at", "_point", F.col("_start").asc_nulls_last()).rowsBetween(W.unboundedPreceding, 0)
    both = both.withColumn("_found", F.last("_start", ignorenulls=True).over(inside)).filter("_point = 1")
    lasts = marks.groupBy(*keys, "_bin").agg(F.max(F.struct("_at", "_start")).alias("_last"))
    bins = both.select(*keys, "_bin").distinct().join(lasts, [*keys, "_bin"], "full")
    carry = bins.withColumn("_carry", F.last("_last._start", ignorenulls=True).over(W.partitionBy(*keys).orderBy("_bin").rowsBetween(W.unboundedPreceding, -1))).select(*keys, "_bin", "_carry")
    out = both.join(carry, [*keys, "_bin"], "left").withColumn("_found", F.coalesce("_found", "_carry"))
    return out.select(*[F.col(c) for c in points.columns], *[F.col(f"_found.{c}").alias(c) for c in payload])


def assign_by_range(points: DataFrame, ranges: DataFrame, keys: list[str], at: str, span: tuple[str, str], payload: list[str], width: int = 65_536) -> DataFrame:
    """Adds to each point the ``payload`` of the closed range ``span`` that holds its offset ``at``; nulls if none does.

    Ranges share no offset. Each is dealt into the bins that it touches, so that no bin needs the ones before, and
    ``ranges``, which may be dear, are made once.
    """
    low, high = span
    bins = F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width)))
    marks = ranges.select(*keys, bins.alias("_bin"), F.col(low).alias("_at"), F.struct(F.col(high).alias("_last"), *payload).alias("_range"))
    rows = points.withColumn("_bin", F.floor(F.col(at) / width)).withColumn("_at", F.col(at)).withColumn("_range", F.lit(None).cast(marks.schema["_range"].dataType)).withColumn("_point", F.lit(1))
    both = rows.unionByName(marks.withColumn("_point", F.lit(0)), allowMissingColumns=True)
    inside = W.partitionBy(*keys, "_bin").orderBy("_at", "_point").rowsBetween(W.unboundedPreceding, 0)
    found = both.withColumn("_found", F.last("_range", ignorenulls=True).over(inside)).filter("_point = 1")
    held = F.col("_found._last") >= F.col(at)
    return found.select(*[F.col(c) for c in points.columns], *[F.when(held, F.col(f"_found.{c}")).alias(c) for c in payload])


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], l_span: tuple[str, str], r_span: tuple[str, str], width: int | None = None) -> DataFrame:
    """Pairs of half-open intervals with equal ``keys`` that share a point; empty intervals share none.

    With ``width`` both sides are dealt into the bins that they touch, so that no key's intervals meet in one task,
    and a pair counts in the bin of the later of its starts alone.
    """
    (ls, le), (rs, re_) = l_span, r_span
    overlap = (F.col(ls) < F.col(re_)) & (F.col(rs) < F.col(le)) & (F.col(ls) < F.col(le)) & (F.col(rs) < F.col(re_))
    if width is None:
        return left.join(right, keys).filter(overlap)
    bins = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / width), F.floor((F.greatest(F.col(e) - 1, F.col(s))) / width)))
    a, b = left.withColumn("_bin", bins(ls, le)), right.withColumn("_bin", bins(rs, re_))
    return a.join(b, [*keys, "_bin"]).filter(overlap & (F.floor(F.greatest(F.col(ls), F.col(rs)) / width) == F.col("_bin"))).drop("_bin")


def islands(df: DataFrame, keys: list[str], order: list, same: Column, out: str) -> DataFrame:
    """Numbers the runs of neighbouring rows for which ``same`` (an expression that may look back) holds."""
    w = W.partitionBy(*keys).orderBy(*order)
    first = F.row_number().over(w) == 1
    marked = df.withColumn("_new", F.when(first | ~F.coalesce(same, F.lit(False)), 1).otherwise(0))
    return marked.withColumn(out, running(F.col("_new"), keys, order)).drop("_new")


def before(c: str, keys: list[str], order: list, offset: int = 1) -> Column:
    return F.lag(c, offset).over(W.partitionBy(*keys).orderBy(*order))


def last_known(c: str, keys: list[str], order: list) -> Column:
    """The last value before the current row that is not null."""
    return F.last(c, ignorenulls=True).over(W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1))


def first_known(c: str, keys: list[str], order: list) -> Column:
    """The first value of the group in order that is not null."""
    return F.first(c, ignorenulls=True).over(W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))


def joined_text(c: str, *order: str) -> Column:
    """An aggregate: a group's texts joined in order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, c))), lambda x: x[c]), "")


def cut(c: str, first: Column, last: Column) -> Column:
    """The items ``first`` to ``last`` (from 1, one at least) of an array, at a cost of these alone; ``slice`` in a lambda goes
    through the whole array."""
    return F.transform(F.sequence(first, last), lambda i: F.element_at(c, i))


def blocks(c: str, size: int) -> Column:
    """An array cut into arrays of so many items, null if it is empty."""
    starts = F.sequence(F.lit(1), F.size(c), F.lit(size))
    return F.when(F.size(c) > 0, F.transform(starts, lambda k: cut(c, k, F.least(k + (size - 1), F.size(c)))))
