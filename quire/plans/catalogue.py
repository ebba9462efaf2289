"""The engine's operators over the driver's tables, by name, with the SQL that gives the same rows.

Most queries run an operator of quire.operators or quire.functions over whole tables; those under "plain aggregates" show
what the engine leaves to Spark's own operators. Numbers are BIGINT on both sides.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.functions.edits import opcodes
from quire.operators import align_exact, align_fuzzy, checks, rollup, spans
from quire.operators import lines as lines_of
from quire.operators import pages as pages_of
from quire.operators import streams as S
from quire.operators import words as words_of
from quire.sources import docx, sqlite
from quire.sources import files as files_of
from quire.spec import LayoutSpec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


TOKENS = r"regexp_split_to_array({}, '[ \t\n\v\f\r]+')"

# tokens and normal forms


@query(f"""
WITH t AS (SELECT doc_id, unnest({TOKENS.format('text')}) AS word, generate_subscripts({TOKENS.format('text')}, 1) AS k FROM documents)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS word_no, word FROM t WHERE word <> ''
""")
def doc_tokens_numbered(spark, sf):
    return words_of.numbered_tokens(table(spark, sf, "documents"), "text", "doc_id")


@query("SELECT doc_id, sha256(strip_accents(coalesce(text, ''))) AS canonical FROM documents")
def doc_canonical_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.sha256(T.canonical(F.col("text"))).alias("canonical"))


# every basic letter and sign in turn, by the line's number
LETTERS = "".join(map(chr, [*range(0x621, 0x63B), *range(0x641, 0x64B), 0x671, 0x6C0, 0x6D3, 0x670, 0x64E, 0x651, 0x640, 0x6DE]))


@query(f"""
WITH t AS (SELECT p_partkey, substr('{LETTERS}', CAST(p_partkey % {len(LETTERS)} AS INTEGER) + 1, 1) || ' ' || substr('{LETTERS}', CAST(p_partkey // {len(LETTERS)} % {len(LETTERS)} AS INTEGER) + 1, 1) || p_name AS x FROM part),
c AS (SELECT *, regexp_replace(translate(x, 'آأإؤئۀۓٱى', 'اااويەےاي'), '[\u064b-\u0655\u0670\u0640\u06de]', '', 'g') AS exact,
  regexp_replace(translate(translate(x, 'ئؤ\u0670', 'ءءا'), 'آأإۀۓٱى', 'اااەےاي'), '[\u064b-\u0655\u0670\u0640\u06de ]', '', 'g') AS fuzzy,
  regexp_replace(translate(x, 'ٱأإآىئؤء', 'ااااييوا'), '[^\u0621-\u063a\u0641-\u064a]', '', 'g') AS mapping,
  trim(regexp_replace(regexp_replace(translate(x, 'آأإؤئۀۓٱ', 'اااويەےا'), '[\u064b-\u0655\u0670\u0640]', '', 'g'), ' +', ' ', 'g')) AS plain FROM t)
SELECT p_partkey, exact, replace(exact, 'ء', '') AS loose, fuzzy, mapping, plain FROM c
""")
def normal_forms(spark, sf):
    """All five normal forms of part names behind two letters or signs."""
    at = lambda k: F.substring(F.lit(LETTERS), (k % len(LETTERS)).cast("int") + 1, 1)
    key = F.col("p_partkey")
    x = F.concat(at(key), F.lit(" "), at(F.floor(key / len(LETTERS))), F.col("p_name"))
    forms = {"exact": T.canonical, "loose": T.canonical_loose, "fuzzy": T.fuzzy_canonical, "mapping": T.mapping_normal, "plain": T.structural}
    return table(spark, sf, "part").select("p_partkey", *[f(x).alias(n) for n, f in forms.items()])


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey < 1000 THEN right('00' || l_partkey, 3) ELSE CAST(l_partkey AS VARCHAR) END AS padded,
  greatest(1, CAST(l_quantity AS BIGINT) - 25) AS one, CASE WHEN l_linenumber > 2 THEN l_partkey END AS number, l_suppkey AS eastern, regexp_matches(l_returnflag, '^[0-9]+$') AS digits, l_returnflag NOT IN ('A', 'off') AS flag
FROM lineitem
""")
def small_functions(spark, sf):
    part = F.col("l_partkey").cast("string")
    eastern = F.translate(F.col("l_suppkey").cast("string"), "0123456789", T.DIGITS_FROM[:10])
    flag = F.when(F.col("l_returnflag") == "A", F.lit("off")).otherwise(F.col("l_returnflag"))
    attribute = F.when(F.col("l_linenumber") > 2, part).otherwise(F.concat(part, F.lit("x")))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", T.padded(F.col("l_partkey")).alias("padded"), big(T.at_least_one(big("l_quantity") - 25)).alias("one"),
        big(T.int_or_null(attribute)).alias("number"), big(T.digits_to_int(eastern)).alias("eastern"), T.is_digits(F.col("l_returnflag")).alias("digits"), T.on_off(flag, F.lit(True)).alias("flag"),
    )


@query("SELECT page_id, length(regexp_replace(html, '<[^>]+>', '', 'g')) AS text_chars, length(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '[ \\t\\n\\v\\f\\r]', '', 'g')) AS plain_chars FROM pages")
def html_strip_tags(spark, sf):
    plain = T.without_tags(F.col("html"))
    return table(spark, sf, "pages").select("page_id", big(F.length(plain)).alias("text_chars"), big(F.length(T.no_space(plain))).alias("plain_chars"))


@query(f"""
WITH t AS (SELECT doc_id, unnest({TOKENS.format('text')}) AS w FROM documents),
p AS (SELECT doc_id, w, regexp_matches(w, '^[0-9]+$') AS d, regexp_matches(w, '^[0-9]+[^0-9]') AS h, regexp_matches(w, '[^0-9][0-9]+$') AS e FROM t WHERE w <> ''),
m AS (
 SELECT doc_id, '' AS token, TRY_CAST(w AS INTEGER) AS marker FROM p WHERE d
 UNION ALL SELECT doc_id, '', TRY_CAST(regexp_extract(w, '^([0-9]+)', 1) AS INTEGER) FROM p WHERE NOT d AND h
 UNION ALL SELECT doc_id, regexp_extract(w, '^[0-9]+(.+)$', 1, 's'), NULL FROM p WHERE NOT d AND h
 UNION ALL SELECT doc_id, regexp_extract(w, '^(.+?)[0-9]+$', 1, 's'), NULL FROM p WHERE NOT d AND NOT h AND e
 UNION ALL SELECT doc_id, '', TRY_CAST(regexp_extract(w, '([0-9]+)$', 1) AS INTEGER) FROM p WHERE NOT d AND NOT h AND e
 UNION ALL SELECT doc_id, w, NULL FROM p WHERE NOT d AND NOT h AND NOT e)
SELECT doc_id, token, CAST(marker AS BIGINT) AS marker, count(*) AS n FROM m GROUP BY ALL
""")
def token_marker_split(spark, sf):
    words = table(spark, sf, "documents").select("doc_id", F.explode(T.tokens(F.col("text"))).alias("w"))
    parts = words.select("doc_id", F.explode(T.split_token(F.col("w"))).alias("p"))
    return parts.groupBy("doc_id", F.col("p.token").alias("token"), big("p.marker").alias("marker")).agg(F.count("*").alias("n"))


@query("SELECT doc_id, sha256(text) AS digest FROM documents")
def sha256_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.sha256(F.col("text")).alias("digest"))


# plain aggregates and roll-ups


@query("SELECT 1 AS edition_id, n_regionkey AS surah, count(*) AS n FROM nation GROUP BY n_regionkey")
def chapter_counts(spark, sf):
    """Regions as chapters, nations as verses."""
    return words_of.chapter_counts(table(spark, sf, "nation").select(F.lit(1).alias("edition_id"), F.col("n_regionkey").alias("surah")))


@query("SELECT r_name, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def nation_counts(spark, sf):
    both = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return both.groupBy("r_name").agg(F.count("*").alias("n"))


@query("SELECT 'verse_total' AS rule, r_name AS key, CAST(n AS VARCHAR) AS detail FROM (SELECT r_name, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name) WHERE n <> 4")
def totals_vs_expected(spark, sf):
    return checks.violation(nation_counts(spark, sf).filter("n <> 4"), "verse_total", F.col("r_name"), F.col("n"))


@query("SELECT count(DISTINCT l_orderkey || ':' || l_linenumber) AS n FROM lineitem")
def distinct_composite_key(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count_distinct(T.key("l_orderkey", "l_linenumber")).alias("n"))


@query("SELECT o_orderkey, count(*) AS n_lines, count(DISTINCT l_linenumber) AS n_numbers, CAST(min(l_linenumber) AS BIGINT) AS first_line, CAST(max(l_linenumber) AS BIGINT) AS last_line, CAST(sum(l_linenumber) AS BIGINT) AS total FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey")
def group_minmax_rollup(spark, sf):
    """Lines are rolled up before they meet their orders, so that no line is sorted for the join; an order that is there
    several times counts its lines as often."""
    line, n = F.col("l_linenumber"), F.col("n")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").filter("l_orderkey is not null")
    # hardly a line repeats: aggregates' tables hold all of a task's rows, so that tasks are many, by the size of the input
    lines = lines.repartition(16 * lines.rdd.getNumPartitions(), "l_orderkey")
    numbers = lines.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))
    rolled = numbers.groupBy("l_orderkey").agg(F.sum(n).alias("n_lines"), F.count(line).alias("n_numbers"), big(F.min(line)).alias("first_line"), big(F.max(line)).alias("last_line"), F.sum(line * n).alias("total"))
    times = table(spark, sf, "orders").groupBy("o_orderkey").agg(F.count("*").alias("times"))
    both = times.join(rolled, F.col("o_orderkey") == F.col("l_orderkey"))
    return both.select("o_orderkey", (F.col("n_lines") * F.col("times")).alias("n_lines"), "n_numbers", "first_line", "last_line", (F.col("total") * F.col("times")).alias("total"))


@query("SELECT l_orderkey, string_agg(l_linenumber || '/' || l_partkey || '/' || l_suppkey, ',' ORDER BY l_linenumber, l_partkey, l_suppkey) AS lines FROM lineitem GROUP BY l_orderkey")
def nested_lines_per_order(spark, sf):
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    lines = F.array_sort(F.collect_list(line))
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(lines, lambda x: F.concat_ws("/", x["l_linenumber"], x["l_partkey"], x["l_suppkey"])), ",").alias("lines"))


@query("SELECT (SELECT count(*) FROM orders) AS n, CAST(count_if(o_totalprice > 200000) AS BIGINT) AS n_large, CAST(max(o_custkey) AS BIGINT) AS last FROM orders")
def filtered_counts(spark, sf):
    return table(spark, sf, "orders").agg(F.count("*").alias("n"), F.count_if(F.col("o_totalprice") > 200000).alias("n_large"), big(F.max("o_custkey")).alias("last"))


# spans and joins by offset


@query("SELECT conv_id, turn, CAST(sum(length(text)) OVER w - length(text) AS BIGINT) AS start, CAST(sum(length(text)) OVER w AS BIGINT) AS stop FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)")
def char_spans(spark, sf):
    rows = table(spark, sf, "conversations").withColumn("stop", S.running(F.length("text"), ["conv_id"], ["turn"]))
    return rows.select("conv_id", "turn", big(F.col("stop") - F.length("text")).alias("start"), big("stop").alias("stop"))


@query(r"""
WITH s AS (SELECT conv_id, turn, regexp_replace(text, '[ \t\n\v\f\r]+', '', 'g') AS seg FROM conversations),
p AS (SELECT conv_id, turn, seg, sum(length(seg)) OVER (PARTITION BY conv_id ORDER BY turn) AS stop FROM s),
t AS (SELECT conv_id, turn, unnest(regexp_split_to_array(text, '[ \t\n\v\f\r]+')) AS w, generate_subscripts(regexp_split_to_array(text, '[ \t\n\v\f\r]+'), 1) AS k FROM conversations),
c AS (SELECT conv_id, turn, k, w, sum(length(w)) OVER (PARTITION BY conv_id ORDER BY turn, k ROWS UNBOUNDED PRECEDING) - length(w) AS at FROM t WHERE w <> '')
SELECT p.conv_id, p.turn, count(*) AS n_words, bool_and(true) AND string_agg(c.w, '' ORDER BY c.at) = any_value(p.seg) AS equal
FROM p JOIN c ON c.conv_id = p.conv_id AND c.at >= p.stop - length(p.seg) AND c.at < p.stop GROUP BY p.conv_id, p.turn
""")
def offset_join_exact(spark, sf):
    conv = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    segs = conv.withColumn("seg", T.no_space(F.col("text"))).withColumn("at", S.running(F.length("seg"), ["conv_id"], ["turn"], before=True)).filter("seg <> ''")
    word = conv.select("conv_id", "turn", F.posexplode(T.tokens(F.col("text"))).alias("k", "w")).withColumn("at", S.running(F.length("w"), ["conv_id"], ["turn", "k"], before=True))
    owned = S.assign_by_offset(word.select("conv_id", "w", "at"), segs.select("conv_id", "at", F.col("turn").alias("of")), ["conv_id"], "at", "at", ["of"])
    spelt = owned.groupBy("conv_id", F.col("of").alias("turn")).agg(F.count("*").alias("n_words"), S.joined_text("w", "at").alias("own"))
    # a segment's text meets its words when they are one row, not each of them
    own = segs.groupBy(F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn")).agg(F.first("seg").alias("seg"))
    both = spelt.join(own, F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("turn").eqNullSafe(F.col("_turn")), "left")
    return both.select("conv_id", "turn", "n_words", (F.col("own") == F.col("seg")).alias("equal"))


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS q, sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate ROWS UNBOUNDED PRECEDING) AS stop FROM lineitem),
b AS (SELECT l_orderkey, unnest(generate_series(0, CAST((max(stop) - 1) // 10 AS BIGINT))) AS bin FROM l GROUP BY l_orderkey)
SELECT l.l_orderkey, b.bin, count(*) AS n, CAST(sum(least(l.stop, b.bin * 10 + 10) - greatest(l.stop - l.q, b.bin * 10)) AS BIGINT) AS overlap
FROM l JOIN b ON l.l_orderkey = b.l_orderkey AND l.stop - l.q < b.bin * 10 + 10 AND b.bin * 10 < l.stop AND l.q > 0 GROUP BY l.l_orderkey, b.bin
""")
def span_overlap_map(spark, sf):
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    line = table(spark, sf, "lineitem").select("l_orderkey", *order, big("l_quantity").alias("q")).withColumn("stop", S.running(F.col("q"), ["l_orderkey"], order)).withColumn("start", F.col("stop") - F.col("q"))
    bins = line.groupBy("l_orderkey").agg(F.max("stop").alias("top")).select("l_orderkey", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("top") - 1) / 10))).alias("bin")).withColumn("b0", F.col("bin") * 10).withColumn("b1", F.col("bin") * 10 + 10)
    pairs = S.overlap_join(line, bins, ["l_orderkey"], ("start", "stop"), ("b0", "b1"))
    return pairs.groupBy("l_orderkey", "bin").agg(F.count("*").alias("n"), big(F.sum(F.least("stop", "b1") - F.greatest("start", "b0"))).alias("overlap"))


@query("SELECT e.event_id, s.event_id AS signup_id FROM events e ASOF LEFT JOIN (SELECT user_id, ts, event_id FROM events WHERE event_type = 'signup') s ON e.user_id = s.user_id AND e.ts >= s.ts")
def boundary_asof(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    starts = events.filter("event_type = 'signup'").select("user_id", "at", F.col("event_id").alias("signup_id"))
    return S.assign_by_offset(events.select("event_id", "user_id", "at"), starts, ["user_id"], "at", "at", ["signup_id"], width=86_400_000_000).select("event_id", "signup_id")


# distances and edits


@query("""
SELECT a.p_partkey AS left_key, b.p_partkey AS right_key, CAST(levenshtein(a.p_name, b.p_name) AS BIGINT) AS distance
FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey
WHERE levenshtein(a.p_name, b.p_name) <= greatest(2, least(6, greatest(2, CAST(floor(length(a.p_name) * 0.25) AS BIGINT))))
""")
def fuzzy_candidates(spark, sf):
    """Names are compared once each in their group, and the pairs of near names bring their parts together. Rows are few
    and their pairs are not: they are dealt out whatever their size."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    group = ["p_brand", "p_size"]
    part = table(spark, sf, "part").select("p_partkey", "p_name", *group)
    name = part.select(*group, "p_name").distinct().repartition(tasks, *group)
    other = name.withColumnRenamed("p_name", "right_name").hint("shuffle_hash")
    limit = T.distance_limit(F.length("p_name"))
    pairs = name.join(other, group).filter(F.abs(F.length("p_name") - F.length("right_name")) <= limit)
    near = pairs.withColumn("distance", T.within_distance(F.col("p_name"), F.col("right_name"), 6)).filter((F.col("distance") >= 0) & (F.col("distance") <= limit))
    right = part.withColumnsRenamed({"p_partkey": "right_key", "p_name": "right_name"})
    left = part.join(near, [*group, "p_name"]).repartition(tasks, *group, "right_name")
    both = left.join(right.hint("shuffle_hash"), [*group, "right_name"]).filter("p_partkey < right_key")
    return both.select(F.col("p_partkey").alias("left_key"), "right_key", big("distance").alias("distance"))


# distances there are of bytes, so that the one letter of two bytes becomes a sign of one
FUZZY_SQL = f"""
WITH RECURSIVE conv AS (SELECT conv_id::INT AS edition_id, (turn + 1)::INT AS page, list_filter({TOKENS.format('text')}, lambda x: x <> '') AS w FROM conversations),
p AS (SELECT *, len(w) AS n, list_transform(w, lambda x: translate(strip_accents(x), 'ß', '~')) AS f FROM conv WHERE len(w) > 0),
lines AS (SELECT edition_id, page, n, f, l::INT AS line, translate(strip_accents(array_to_string(list_transform(w[l * 8 + 1:l * 8 + 8], lambda x, i: CASE WHEN (i - 1) % 4 = 3 THEN 'q' || substr(x, 2) ELSE x END), '')), 'ß', '~') AS s
  FROM (SELECT *, unnest(range(0, (n - 1) // 8 + 1)) AS l FROM p)),
limits AS (SELECT *, greatest(2, least(6, greatest(2, floor(length(s) * 0.25)::BIGINT))) AS most FROM lines),
walk(edition_id, page, line, stop, cost, start, distance, place) AS (SELECT edition_id, page, -1, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 1::BIGINT FROM p
 UNION ALL SELECT edition_id, page, line, stop, cost, start, distance, row_number() OVER (PARTITION BY edition_id, page, line ORDER BY reached, stop) FROM (
  SELECT *, row_number() OVER (PARTITION BY edition_id, page, line, stop ORDER BY cost, came) AS best, min(came) OVER (PARTITION BY edition_id, page, line, stop) AS reached FROM (
   SELECT edition_id, page, line, stop, cost + levenshtein(s, run) AS cost, start, levenshtein(s, run) AS distance, place AS came, most FROM (
    SELECT *, array_to_string(f[start + 1:stop], '') AS run FROM (
     SELECT k.edition_id, k.page, s.line, s.s, s.f, s.most, k.cost, k.place, k.stop AS start, unnest(range(k.stop + 1, least(k.stop + 16, s.n) + 1)) AS stop FROM walk k JOIN limits s ON s.edition_id = k.edition_id AND s.page = k.page AND s.line = k.line + 1)))
   WHERE distance <= most) WHERE best = 1),
ends AS (SELECT edition_id, page, max(n) AS n, max(line) AS line FROM limits GROUP BY edition_id, page),
back AS (SELECT w.* FROM walk w JOIN ends e ON w.edition_id = e.edition_id AND w.page = e.page AND w.line = e.line AND w.stop = e.n
 UNION ALL SELECT w.* FROM back b JOIN walk w ON w.edition_id = b.edition_id AND w.page = b.page AND w.line = b.line - 1 AND w.stop = b.start WHERE b.line > 0)
SELECT edition_id, page, line, start, stop, distance::INT AS distance, 'ok' AS status FROM back
UNION ALL SELECT e.edition_id, e.page, NULL, NULL, NULL, NULL, CASE WHEN max(w.line) = max(e.line) THEN 'wrong_end' ELSE 'no_state' END FROM ends e JOIN walk w ON w.edition_id = e.edition_id AND w.page = e.page
 WHERE NOT EXISTS (SELECT 1 FROM back b WHERE b.edition_id = e.edition_id AND b.page = e.page) GROUP BY e.edition_id, e.page
"""


def _fuzzy_path(spark, sf) -> DataFrame:
    """Turns of conversations as pages, eight words a line, a letter changed in every fourth word, against their words."""
    conv = table(spark, sf, "conversations").select(big("conv_id").cast("int").alias("edition_id"), (F.col("turn") + 1).cast("int").alias("page"), T.tokens(F.col("text")).alias("w")).filter(F.size("w") > 0)
    line = conv.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.size("w") - 1) / 8).cast("int"))).alias("line"))
    changed = F.transform(F.slice("w", F.col("line") * 8 + 1, 8), lambda x, i: F.when(i % 4 == 3, F.concat(F.lit("q"), F.substring(x, 2, 9999))).otherwise(x))
    segs = line.select("edition_id", "page", "line", F.lit(0).alias("seg"), F.lit(1).alias("surah"), F.array_join(changed, "").alias("text"), F.lit(None).cast("int").alias("marker"))
    word = conv.select("edition_id", "page", F.posexplode("w").alias("k", "word"))
    word = word.select("edition_id", F.lit(1).alias("surah"), F.lit(1).alias("ayah"), "page", (big("page") * 1_000_000 + F.col("k")).alias("pos"), "word", F.lit(1).alias("wordIndex"), T.fuzzy_canonical(F.col("word")).alias("f"))
    return align_fuzzy.align_pages(segs, word, LayoutSpec(max_words=16))


@query(FUZZY_SQL)
def fuzzy_segmentation(spark, sf):
    return _fuzzy_path(spark, sf).select("edition_id", "page", "line", "start", "stop", "distance", "status")


@query(f"WITH path AS ({FUZZY_SQL}) SELECT edition_id, count_if(distance > 0)::BIGINT AS fuzzy_segments, coalesce(sum(distance), 0)::BIGINT AS total_edit_distance FROM path GROUP BY edition_id")
def fuzzy_totals(spark, sf):
    """What a manifest says of a fuzzy build."""
    return align_fuzzy.path_totals(_fuzzy_path(spark, sf))


def _paged_documents(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Documents as editions: their lines, and segments of 15 lines that hold text; every fourth break of pages is missing."""
    docs = table(spark, sf, "documents").select(big("doc_id").cast("int").alias("edition_id"), F.posexplode(F.split("text", "\n")).alias("k", "text"))
    lines = docs.select("edition_id", big("k").alias("line_no"), F.regexp_replace("text", "[<>]", "").alias("text"))
    text = lines.filter(T.has_text(F.col("text")))
    placed = S.ordinal(text, ["edition_id"], ["line_no", pages_of.same_line(F.col("text"))], "n").withColumn("page", F.floor((F.col("n") - 1) / 15).cast("int"))
    segment = (F.col("page") - F.floor((F.col("page") + 2) / 4)).cast("int")
    parts = placed.select("edition_id", segment.alias("segment_no"), "n", F.concat(F.lit("<p>"), "text", F.lit("</p>")).alias("xml"))
    segments = parts.groupBy("edition_id", "segment_no").agg(S.joined_text("xml", "n").alias("xml"))
    return pages_of.printed_pages(lines, segments, LayoutSpec(max_lines=15))


@query("SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderpriority >= '3' AND o_orderstatus IN ('F', 'o') AND o_orderkey > 100")
def relational_round_trip(spark, sf):
    """Orders through a SQLite file whose key is no row number and whose texts do not tell cases apart, read back by ranges of
    the key with filters that the file judges."""
    path = files_of.scratch(spark, "orders").removeprefix("file://") + ".sqlite"
    names = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    ddl = "CREATE TABLE orders (o_orderkey INTEGER, o_orderstatus TEXT COLLATE NOCASE, o_totalprice REAL, o_orderpriority TEXT, PRIMARY KEY (o_orderstatus, o_orderkey)) WITHOUT ROWID"
    sqlite.write(table(spark, sf, "orders").select(names), path, "orders", ddl, ["o_orderstatus", "o_orderkey"])
    back = sqlite.read(spark, path, "orders", partitions=8)
    return back.filter("o_orderpriority >= '3' AND o_orderstatus IN ('F', 'o') AND o_orderkey > 100").select(big("o_orderkey").alias("o_orderkey"), *names[1:])


@query("SELECT 2 AS edition_id, l_orderkey::INT AS surah, l_linenumber::INT AS ayah, l_partkey::INT AS hafs_ayah FROM lineitem GROUP BY ALL UNION ALL SELECT 1, n_nationkey::INT, 1, 1 FROM nation")
def mapping_export(spark, sf):
    """The mapping's relational form: exported to one file whole, and read back by ranges of its key of four columns."""
    path = files_of.scratch(spark, "mapping").removeprefix("file://") + ".sqlite"
    mapped = _line_mapping(spark, sf).select(*(F.col(c).cast("int").alias(c) for c in ("edition_id", "surah", "ayah", "hafs_ayah")))
    identity = table(spark, sf, "nation").select(F.lit(1).alias("edition_id"), F.col("n_nationkey").cast("int").alias("surah"), F.lit(1).alias("ayah"), F.lit(1).alias("hafs_ayah"))
    editions = spark.createDataFrame([(1, "a", "a", 1, "a"), (2, "b", "b", 1, "a")], "edition_id int, edition_key string, rawi string, ayah_count int, reference string")
    sqlite.export(path, {"metadata": files_of.metadata_rows(spark, {"schema_version": 1}), "editions": editions, "ayah_hafs_map": identity.unionByName(mapped)})
    return sqlite.read(spark, path, "ayah_hafs_map", "edition_id int, surah int, ayah int, hafs_ayah int", partitions=8)


@query("""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS k FROM documents),
e AS (SELECT doc_id, k, unnest(CASE WHEN contains(x, ' ') THEN [split_part(x, ' ', 1), NULL, substr(x, strpos(x, ' ') + 1)] ELSE [x] END) AS value, unnest(CASE WHEN contains(x, ' ') THEN [0, 1, 2] ELSE [0] END) AS n FROM l)
SELECT doc_id::VARCHAR AS doc, k::INT AS para_no, n::INT AS event_no, CASE WHEN n = 1 THEN 'line_break' ELSE 'text' END AS type, value, n <> 2 AS bold, CASE WHEN n <> 2 THEN 24 END AS size FROM e
""")
def styled_events(spark, sf):
    """Documents as styled files, a paragraph a line, its first word in bold and a line break after it, parsed again."""

    def files(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc": pdf.doc_id.astype(str), "content": [_styled_file(t or "") for t in pdf.text]})

    # one file of a table is one task else
    dealt = table(spark, sf, "documents").select("doc_id", "text").repartition("doc_id")
    docs = dealt.mapInPandas(files, "doc string, content binary")
    return docx.events(docs, "Font").select("doc", "para_no", "event_no", "type", "value", F.col("style.bold").alias("bold"), F.col("style.font_size_half_points").alias("size"))


def _styled_file(text: str) -> bytes:
    """A styled document of a text's lines."""
    safe = lambda x: escape(x, {"\r": "&#13;"})
    first = '<w:r><w:rPr><w:b/><w:sz w:val="24"/></w:rPr><w:t xml:space="preserve">{}</w:t>{}</w:r>'
    rest = '<w:r><w:rPr/><w:t xml:space="preserve">{}</w:t></w:r>'
    cut = (line.partition(" ") for line in text.split("\n"))
    body = "".join("<w:p>" + first.format(safe(a), "<w:br/>" if space else "") + (rest.format(safe(b)) if space else "") + "</w:p>" for a, space, b in cut)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("word/document.xml", f'<w:document xmlns:w="{docx.NAMESPACE[1:-1]}"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


PRINTED_SQL = """
WITH l AS (SELECT doc_id::INT AS edition_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents),
t AS (SELECT edition_id, k, regexp_replace(translate(x, '<>', ''), '\\s+$', '') AS text FROM l WHERE trim(translate(x, '<>', ''), chr(32) || chr(9) || chr(13)) <> ''),
n AS (SELECT *, row_number() OVER (PARTITION BY edition_id ORDER BY k) - 1 AS n FROM t)
"""


@query(PRINTED_SQL + "SELECT edition_id, (n // 15 + 1)::INT AS page, (n % 15 + 1)::INT AS line_in_page, text FROM n")
def printed_pages(spark, sf):
    """Lines on pages, with the missing breaks repaired."""
    return _paged_documents(spark, sf)[0]


@query(PRINTED_SQL + """, p AS (SELECT edition_id, n // 15 AS page, count(*) AS n FROM n GROUP BY ALL),
s AS (SELECT edition_id, page - (page + 2) // 4 AS segment, sum(n)::BIGINT AS n FROM p GROUP BY ALL)
SELECT 'page_segment_size' AS rule, edition_id || ':' || segment AS key, 'lines: ' || n AS detail FROM s WHERE n > 15 AND n % 15 <> 0
""")
def page_break_violations(spark, sf):
    """Segments that no full pages fit."""
    return _paged_documents(spark, sf)[1]


@query("""
WITH RECURSIVE pairs AS (SELECT a.item_id, b.item_id AS to_id, string_split(a.text, '') AS s, string_split(b.text, '') AS t FROM benchmark a JOIN benchmark b ON split_part(a.text, ' ', 1) = split_part(b.text, ' ', 1) AND a.item_id < b.item_id),
heads AS (SELECT *, coalesce(list_min(list_filter(range(1, least(len(s), len(t)) + 1), lambda k: s[k] <> t[k])) - 1, least(len(s), len(t))) AS head FROM pairs),
tails AS (SELECT *, coalesce(list_min(list_filter(range(0, least(len(s), len(t)) - head), lambda k: s[len(s) - k] <> t[len(t) - k])), least(len(s), len(t)) - head) AS tail FROM heads),
mid AS (SELECT item_id, to_id, head, tail, s[head + 1:len(s) - tail] AS a, t[head + 1:len(t) - tail] AS b FROM tails),
rows_(item_id, to_id, a, b, i, d) AS (SELECT item_id, to_id, a, b, 0::BIGINT, range(0, len(b) + 1) FROM mid
 UNION ALL SELECT item_id, to_id, a, b, i + 1, list_transform(range(1, len(b) + 2), lambda j: j - 1 + list_min(best[1:j])) FROM (SELECT item_id, to_id, a, b, i,
  list_transform(range(1, len(b) + 2), lambda j: CASE WHEN j = 1 THEN i + 1 ELSE least(d[j] + 1, d[j - 1] + CASE WHEN a[i + 1] = b[j - 1] THEN 0 ELSE 1 END) END - (j - 1)) AS best FROM rows_ WHERE i < len(a))),
back(item_id, to_id, i, j, n, op) AS (SELECT item_id, to_id, len(a), len(b), 0::BIGINT, '' FROM mid
 UNION ALL SELECT item_id, to_id, CASE WHEN step = 'insert' THEN i ELSE i - 1 END, CASE WHEN step = 'delete' THEN j ELSE j - 1 END, n + 1, step FROM (SELECT k.item_id, k.to_id, k.i, k.j, k.n,
  CASE WHEN k.j = 0 THEN 'delete' WHEN k.i = 0 THEN 'insert' WHEN up.d[k.j + 1] + 1 = r.d[k.j + 1] THEN 'delete' WHEN r.d[k.j] + 1 = r.d[k.j + 1] THEN 'insert' WHEN r.a[k.i] = r.b[k.j] THEN 'equal' ELSE 'replace' END AS step
  FROM back k JOIN rows_ r ON r.item_id = k.item_id AND r.to_id = k.to_id AND r.i = k.i LEFT JOIN rows_ up ON up.item_id = k.item_id AND up.to_id = k.to_id AND up.i = k.i - 1 WHERE k.i > 0 OR k.j > 0)),
steps AS (SELECT item_id, to_id, -n AS k, op, (op <> 'insert')::BIGINT AS x, (op <> 'delete')::BIGINT AS y FROM back WHERE op <> ''
 UNION ALL SELECT item_id, to_id, -1000000000, 'equal', head, head FROM mid WHERE head > 0 UNION ALL SELECT item_id, to_id, 0, 'equal', tail, tail FROM mid WHERE tail > 0),
fresh AS (SELECT *, CASE WHEN lag(op) OVER (PARTITION BY item_id, to_id ORDER BY k) = op THEN 0 ELSE 1 END AS f FROM steps),
runs AS (SELECT *, sum(f) OVER (PARTITION BY item_id, to_id ORDER BY k) AS run FROM fresh),
blocks AS (SELECT item_id, to_id, run, any_value(op) AS tag, sum(x) AS x, sum(y) AS y FROM runs GROUP BY item_id, to_id, run),
ends AS (SELECT *, sum(x) OVER w AS sx, sum(y) OVER w AS sy FROM blocks WINDOW w AS (PARTITION BY item_id, to_id ORDER BY run))
SELECT item_id, to_id, (run - 1)::INT AS op, tag, (sx - x)::INT AS src_start, sx::INT AS src_end, (sy - y)::INT AS dest_start, sy::INT AS dest_end FROM ends
""")
def edit_opcodes(spark, sf):
    """Edit scripts from each benchmark item to every later one of equal first word."""
    item = table(spark, sf, "benchmark").select("item_id", "text", F.substring_index("text", " ", 1).alias("head"))
    pairs = item.join(item.select(F.col("item_id").alias("to_id"), F.col("text").alias("target"), "head"), "head").filter("item_id < to_id")

    def run(batches):
        for pdf in batches:
            rows = [(a, b, k, *op) for a, b, s, t in zip(pdf.item_id, pdf.to_id, pdf.text, pdf.target, strict=True) for k, op in enumerate(opcodes(s, t))]
            yield pd.DataFrame(rows, columns=["item_id", "to_id", "op", "tag", "src_start", "src_end", "dest_start", "dest_end"])

    return pairs.select("item_id", "to_id", "text", "target").mapInPandas(run, "item_id bigint, to_id bigint, op int, tag string, src_start int, src_end int, dest_start int, dest_end int")


def _sign(c: str, base: int) -> Column:
    """A character of the number's own."""
    return F.decode(F.unhex(F.hex(F.col(c) + base)), "UTF-16BE")


def _editions(spark, sf) -> DataFrame:
    """Conversations as chapters of three editions. The first has every turn as a verse, between two characters of the turn's
    own. The second lacks the second turn of every fifth chapter, adds a sign inside every fourth turn, changes the second
    character of others and joins every fourth turn to the one before. The third cuts every turn in two."""
    conv = table(spark, sf, "conversations").select(big("conv_id").cast("int").alias("surah"), big("turn").cast("int").alias("t"), F.coalesce("text", F.lit("")).alias("x"))
    conv = conv.withColumn("x", F.concat(_sign("t", 0x4E00), "x", _sign("t", 0x5E00)))
    first = conv.select(F.lit(1).alias("edition_id"), "surah", F.col("t").alias("ayah"), F.col("x").alias("text"))
    kind = F.col("t") % 4
    edited = F.when(kind == 1, F.concat(F.substring("x", 1, 2), F.lit("@"), F.expr("substring(x, 3)"))).when((kind == 2) & (F.length("x") > 4), F.concat(F.substring("x", 1, 1), F.lit("#"), F.expr("substring(x, 3)"))).otherwise(F.col("x"))
    kept = conv.filter("not (surah % 5 = 0 and t = 1)").select("surah", (F.col("t") - (kind == 3).cast("int")).alias("ayah"), F.struct("t", edited.alias("x")).alias("part"))
    second = kept.groupBy("surah", "ayah").agg(F.array_join(F.sort_array(F.collect_list("part"))["x"], "").alias("text")).select(F.lit(2).alias("edition_id"), "surah", "ayah", "text")
    half = F.floor(F.length("x") / 2).cast("int")
    halves = F.explode(F.array(F.struct((F.col("t") * 2).alias("ayah"), F.substring(F.col("x"), F.lit(1), half).alias("text")), F.struct((F.col("t") * 2 + 1).alias("ayah"), F.substring(F.col("x"), half + 1, F.length("x")).alias("text"))))
    third = conv.select(F.lit(3).alias("edition_id"), "surah", halves.alias("h")).select("edition_id", "surah", "h.*")
    return first.unionByName(second).unionByName(third)


@query("""
WITH v AS (SELECT conv_id::INT AS surah, turn::INT AS t, length(coalesce(text, '')) + 2 AS n FROM conversations),
goal AS (SELECT *, sum(n) OVER (PARTITION BY surah ORDER BY t) AS stop FROM v WHERE NOT (surah = 1 AND t = (SELECT min(t) FROM v WHERE surah = 1))),
kept AS (SELECT v.surah, v.t, v.t - (v.t % 4 = 3)::INT AS ayah, coalesce(stop, 0) AS stop FROM v LEFT JOIN goal g ON v.surah = g.surah AND v.t = g.t WHERE NOT (v.surah % 5 = 0 AND v.t = 1)),
lagged AS (SELECT *, lag(stop, 1, 0) OVER (PARTITION BY surah ORDER BY t) AS start FROM kept),
second AS (SELECT surah, ayah, min(start) AS a, max(stop) AS b FROM lagged GROUP BY surah, ayah)
SELECT 1 AS edition_id, surah, t AS ayah, t AS hafs_ayah FROM v
UNION ALL SELECT 2, s.surah, s.ayah, g.t FROM second s JOIN goal g ON s.surah = g.surah AND s.a < s.b AND g.stop - g.n < s.b AND g.stop > s.a
UNION ALL SELECT 3, surah, (t * 2 + h)::INT, t FROM goal, range(2) r(h)
""")
def edition_map(spark, sf):
    """The whole mapping between editions: scripts of chapters, boundaries carried over, overlaps."""
    return spans.map_editions(_editions(spark, sf), normal=F.col("text"))[0]


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round_even(l_quantity / 2, 0) AS DOUBLE) AS half FROM lineitem")
def half_even_round(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", T.half_even(F.col("l_quantity") / 2).cast("double").alias("half"))


# state carried along a stream


@query("SELECT event_id, CAST(count_if(event_type = 'signup') OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS chapter FROM events")
def running_chapter(spark, sf):
    return table(spark, sf, "events").select("event_id", big(S.running((F.col("event_type") == "signup").cast("int"), ["user_id"], ["ts", "event_id"])).alias("chapter"))


@query("SELECT event_id, CAST(row_number() OVER (ORDER BY ts, event_id) - 1 AS BIGINT) AS pos, CAST(sum(CAST(floor(value) AS BIGINT)) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM events")
def global_position(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "ts", "value", F.lit(1).alias("edition_id"), F.to_date("ts").alias("day"))
    rows = S.prefix_sum(rows, F.lit(1), ["edition_id"], "day", ["ts", "event_id"], "pos")
    return S.prefix_sum(rows, F.floor("value"), ["edition_id"], "day", ["ts", "event_id"], "total", before=False).select("event_id", "pos", "total")


@query("""
WITH g AS (SELECT event_id, user_id, ts, event_type, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_purchase,
 coalesce(count_if(event_type = 'purchase') OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS grp FROM events)
SELECT event_id, last_purchase, CASE WHEN event_type <> 'purchase' THEN CAST(count_if(event_type <> 'purchase') OVER (PARTITION BY user_id, grp ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) END AS word_no FROM g
""")
def marker_numbering(spark, sf):
    keys, order = ["user_id"], ["ts", "event_id"]
    marker = F.when(F.col("event_type") == "purchase", F.col("event_id"))
    rows = table(spark, sf, "events").select("event_id", "user_id", "ts", marker.alias("marker"))
    rows = rows.withColumn("last_purchase", S.last_known("marker", keys, order))
    return words_of.inline_numbering(rows, keys, order).select("event_id", "last_purchase", big("wordIndex").alias("word_no"))


@query("""
WITH m AS (SELECT *, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM m)
SELECT user_id, CAST(run AS BIGINT) AS run, any_value(event_type) AS event_type, count(*) AS n, string_agg(CAST(event_id AS VARCHAR), '' ORDER BY ts, event_id) AS joined FROM i GROUP BY user_id, run
""")
def merge_runs(spark, sf):
    keys, order = ["user_id"], ["ts", "event_id"]
    rows = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", F.col("event_id").cast("string").alias("id_text"))
    runs = S.islands(rows, keys, order, S.before("event_type", keys, order) == F.col("event_type"), "run")
    return runs.groupBy("user_id", big("run").alias("run")).agg(F.first("event_type").alias("event_type"), F.count("*").alias("n"), S.joined_text("id_text", "ts", "event_id").alias("joined"))


@query("""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents)
SELECT doc_id, (k - 1) // 15 + 1 AS page, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS chars FROM l GROUP BY doc_id, page
""")
def page_chunks(spark, sf):
    line = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("k", "line"))
    page = (F.floor(F.col("k") / 15) + 1).cast("long")
    return line.groupBy("doc_id", page.alias("page")).agg(F.count("*").alias("n_lines"), big(F.sum(F.length("line"))).alias("chars"))


@query("SELECT user_id, arg_min(value, struct_pack(a := ts, b := event_id)) FILTER (event_type = 'error') AS first_error FROM events GROUP BY user_id")
def first_nonnull(spark, sf):
    rows = table(spark, sf, "events").withColumn("error", F.when(F.col("event_type") == "error", F.col("value")))
    return rows.withColumn("first_error", S.first_known("error", ["user_id"], ["ts", "event_id"])).groupBy("user_id").agg(F.first("first_error").alias("first_error"))


# sets


@query("SELECT 'missing_labelled' AS rule, CAST(x AS VARCHAR) AS key, '' AS detail FROM range(0, (SELECT max(doc_id) + 1 FROM documents)) r(x) ANTI JOIN labels ON x = doc_id")
def missing_spine(spark, sf):
    top = table(spark, sf, "documents").agg(F.max("doc_id")).first()[0]
    return checks.spine(table(spark, sf, "labels"), "doc_id", 0, top, "labelled")


@query("SELECT 'missing_id' AS rule, CAST(doc_id AS VARCHAR) AS key, '' AS detail FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'extra_id', CAST(doc_id AS VARCHAR), '' FROM (SELECT DISTINCT doc_id FROM labels) WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def set_equality(spark, sf):
    ids = lambda t: table(spark, sf, t).select("doc_id")
    return checks.set_equality(ids("labels"), ids("documents"), "id")


@query("SELECT 'unlabelled' AS rule, CAST(doc_id AS VARCHAR) AS key, '' AS detail FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)")
def set_difference(spark, sf):
    return checks.difference(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels").select("doc_id"), "unlabelled")


@query("SELECT count(*) = 0 AS is_subset FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)")
def subset(spark, sf):
    lost = checks.difference(table(spark, sf, "labels").select("doc_id"), table(spark, sf, "documents").select("doc_id"), "lost")
    return lost.agg((F.count("*") == 0).alias("is_subset"))


@query("""
SELECT 1 AS edition_id, CAST(n_nationkey AS INTEGER) AS ayah, CAST(n_nationkey AS INTEGER) AS hafs_ayah FROM nation
UNION ALL SELECT 2, CAST(c_custkey AS INTEGER), CAST(c_nationkey AS INTEGER) FROM customer
""")
def union_mapping_rows(spark, sf):
    key = F.col("n_nationkey").cast("int")
    identity = table(spark, sf, "nation").select(F.lit(1).alias("edition_id"), key.alias("ayah"), key.alias("hafs_ayah"))
    mapped = table(spark, sf, "customer").select(F.lit(2).alias("edition_id"), F.col("c_custkey").cast("int").alias("ayah"), F.col("c_nationkey").cast("int").alias("hafs_ayah"))
    return identity.unionByName(mapped)


def _line_mapping(spark, sf) -> DataFrame:
    """Lines as verses of chapters, without repeats. All that follows goes by chapter: rows are dealt by it, into tasks by the size of
    the input, as aggregates' tables and sorts hold a task's rows."""
    lines = table(spark, sf, "lineitem").select(F.lit(2).alias("edition_id"), F.col("l_orderkey").alias("surah"), F.col("l_linenumber").alias("ayah"), F.col("l_partkey").alias("hafs_ayah"))
    return lines.repartition(16 * lines.rdd.getNumPartitions(), "surah").distinct()


@query("SELECT 2 AS edition_id, l_orderkey AS surah, l_linenumber AS ayah, count(DISTINCT l_partkey) AS n, array_to_string(list_sort(list(DISTINCT l_partkey)), ',') AS refs FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_partkey) > 1")
def multi_refs(spark, sf):
    return spans.multiple_references(_line_mapping(spark, sf)).withColumn("refs", F.array_join(F.col("refs").cast("array<string>"), ","))


@query("SELECT l_partkey AS hafs_ayah FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_orderkey = 7 AND l_linenumber = 1)")
def point_lookup(spark, sf):
    return spans.references(_line_mapping(spark, sf), 2, 7, 1)


# sort and limit


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def topk_states(spark, sf):
    return table(spark, sf, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").select("o_orderkey", "o_totalprice").limit(5)


@query("SELECT 'identity' AS rule, c_custkey || ':' || c_custkey AS key, CAST(c_nationkey AS VARCHAR) AS detail FROM customer WHERE c_custkey <> c_nationkey ORDER BY c_custkey LIMIT 1")
def first_violation(spark, sf):
    rows = table(spark, sf, "customer").filter("c_custkey <> c_nationkey").orderBy("c_custkey").limit(1)
    return checks.violation(rows, "identity", T.key("c_custkey", "c_custkey"), F.col("c_nationkey"))


# constraints


@query("""
WITH n AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem),
w AS (SELECT *, lag(l_linenumber, 1, 0) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS before FROM n)
SELECT 'continuity' AS rule, l_orderkey || ':' || l_linenumber AS key, before || '>' || l_linenumber AS detail FROM w WHERE l_linenumber <> before + 1
""")
def continuity_violations(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    before = F.coalesce(S.before("l_linenumber", ["l_orderkey"], ["l_linenumber"]), F.lit(0))
    bad = rows.withColumn("before", before).filter("l_linenumber <> before + 1")
    return checks.violation(bad, "continuity", T.key("l_orderkey", "l_linenumber"), F.concat_ws(">", "before", "l_linenumber"))


@query("""
WITH r AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS low, max(l_partkey) AS high, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY ALL),
b AS (SELECT *, lag(high) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS back FROM r)
SELECT 'reference_gap' AS rule, '2:' || l_orderkey || ':' || l_linenumber AS key, low || ':' || high AS detail FROM r WHERE high - low + 1 <> n
UNION ALL SELECT 'reference_order', '2:' || l_orderkey || ':' || l_linenumber, back || ':' || low FROM b WHERE low < back
""")
def contiguous_monotone(spark, sf):
    return checks.mapping_monotone(_line_mapping(spark, sf))


@query("""
WITH a(n, want) AS (VALUES ('FRANCE', 'EUROPE'), ('JAPAN', 'ASIA'), ('NATION_1', 'ASIA'), ('NATION_2', 'AFRICA'))
SELECT 'anchor' AS rule, a.n AS key, coalesce(r_name, '') AS detail FROM a LEFT JOIN (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) x ON a.n = n_name WHERE r_name IS DISTINCT FROM want
""")
def anchors(spark, sf):
    want = spark.createDataFrame([("FRANCE", "EUROPE"), ("JAPAN", "ASIA"), ("NATION_1", "ASIA"), ("NATION_2", "AFRICA")], "n_name string, want string")
    have = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")
    return checks.violation(want.join(have, "n_name", "left").filter(~F.col("r_name").eqNullSafe(F.col("want"))), "anchor", F.col("n_name"), F.col("r_name"))


@query("""
SELECT 'orphan_label' AS rule, CAST(doc_id AS VARCHAR) AS key, '' AS detail FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'orphan_order', CAST(l_orderkey AS VARCHAR), '' FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
""")
def referential_violations(spark, sf):
    docs = checks.foreign_key(table(spark, sf, "documents"), table(spark, sf, "labels"), ["doc_id"], "label")
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return docs.unionByName(checks.foreign_key(lines, table(spark, sf, "orders"), ["o_orderkey"], "order"))


@query("""
WITH a AS (SELECT (o_custkey % 3 + 1)::INT AS e, (o_orderkey % 12 + 1)::INT AS s FROM orders),
w AS (SELECT e.range::INT AS e, s.range::INT AS s FROM range(1, 4) e, range(1, 11) s)
SELECT 'missing_chapter' AS rule, e || ':' || s AS key, '' AS detail FROM (SELECT * FROM w EXCEPT SELECT * FROM a)
UNION ALL SELECT 'extra_chapter', e || ':' || s, '' FROM (SELECT * FROM a EXCEPT SELECT * FROM w)
UNION ALL SELECT 'verse_total', e::VARCHAR, n::VARCHAR FROM (SELECT e, count(*) AS n FROM a GROUP BY e) JOIN (VALUES (1, 100), (2, 4907), (3, 300)) x(k, want) ON e = k WHERE n <> want
""")
def chapter_total_violations(spark, sf):
    ayat = table(spark, sf, "orders").select((F.col("o_custkey") % 3 + 1).cast("int").alias("edition_id"), (F.col("o_orderkey") % 12 + 1).cast("int").alias("surah"))
    return checks.chapter_totals(ayat, LayoutSpec(chapters=10), {1: 100, 2: 4907, 3: 300})


@query("""
SELECT 'line_keys' AS rule, x AS key, '' AS detail FROM (SELECT '{"line":' || l_linenumber || ',"first_word":' || l_orderkey || CASE l_linenumber % 4 WHEN 0 THEN '}' WHEN 1 THEN ',"end_word":0}' WHEN 2 THEN ',"end_word":0,"more":1}' ELSE ',"end":0}' END AS x, l_linenumber % 4 AS k FROM lineitem) WHERE k <> 1
""")
def line_key_violations(spark, sf):
    """Records of lines whose keys are not those of a line."""
    number = lambda c: F.col(c).cast("string")
    kind = F.col("l_linenumber") % 4
    rest = F.when(kind == 0, "}").when(kind == 1, ',"end_word":0}').when(kind == 2, ',"end_word":0,"more":1}').otherwise(',"end":0}')
    rows = table(spark, sf, "lineitem").select(F.concat(F.lit('{"line":'), number("l_linenumber"), F.lit(',"first_word":'), number("l_orderkey"), rest).alias("json"))
    return checks.line_keys(rows)


@query("SELECT 'duplicate_line' AS rule, l_orderkey || ':' || l_linenumber AS key, CAST(count(*) AS VARCHAR) AS detail FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return checks.not_unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "line")


@query("SELECT 'page_lines' AS rule, '1:' || conv_id AS key, CAST(count(*) AS VARCHAR) AS detail FROM conversations GROUP BY conv_id HAVING count(*) > 6 OR min(turn) <> 0 OR max(turn) <> count(*) - 1")
def page_cardinality(spark, sf):
    """Conversations as pages of at most six lines."""
    turns = table(spark, sf, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"), F.min("turn").alias("low"), F.max("turn").alias("high"))
    return checks.violation(turns.filter("n > 6 or low <> 0 or high <> n - 1"), "page_lines", T.key(F.lit("1"), "conv_id"), F.col("n"))


@query("""
WITH w AS (SELECT conv_id, turn, len(list_filter(regexp_split_to_array(text, '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '')) AS n FROM conversations)
SELECT CAST(conv_id AS BIGINT) AS surah, min(turn) AS start_page, max(turn) AS end_page, count(*) AS n_pages, CAST(sum(n) AS BIGINT) AS n_lines FROM w WHERE n > 0 GROUP BY conv_id
""")
def chapter_rollup(spark, sf):
    """Conversations as chapters, turns as pages, words as lines: the chapter records of the layout."""
    word = table(spark, sf, "conversations").select(F.lit(1).alias("edition_id"), big("conv_id").cast("int").alias("surah"), big("turn").cast("int").alias("page"), F.posexplode(T.tokens(F.col("text"))).alias("k", "w"))
    end = F.struct(F.lit("word").alias("type"), F.col("surah"), F.lit(1).alias("ayah"), F.col("w").alias("word"), (F.col("k") + 1).alias("wordIndex"), F.lit(None).cast("int").alias("number"))
    lines = word.withColumn("line", F.col("k") + 1).withColumn("first_word", end).withColumn("end_word", end)
    names = lines.select("edition_id", "surah", F.lit("").alias("surahName")).distinct()
    out = rollup.chapter_records(lines, names, LayoutSpec())
    return out.select(big("surahId").alias("surah"), big("startPage").alias("start_page"), big("endPage").alias("end_page"), big("totalPagesInSurah").alias("n_pages"), big("totalCompletedLines").alias("n_lines"))


@query("SELECT l_orderkey, CAST(min(l_suppkey) AS BIGINT) AS supplier, arg_min(l_partkey, struct_pack(a := l_suppkey, b := l_extendedprice, c := l_partkey)) AS part FROM lineitem GROUP BY l_orderkey")
def least_state(spark, sf):
    order = F.struct("l_suppkey", "l_extendedprice", "l_partkey")
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(big(F.min("l_suppkey")).alias("supplier"), F.min_by("l_partkey", order).alias("part"))


@query("SELECT event_id, CAST(dense_rank() OVER (PARTITION BY user_id ORDER BY event_type) AS BIGINT) AS page FROM events")
def dense_pages(spark, sf):
    return table(spark, sf, "events").select("event_id", big(F.dense_rank().over(W.partitionBy("user_id").orderBy("event_type"))).alias("page"))


# an edition made of conversations: chapters, verses of turns, lines of eight words


def _verses(spark, sf) -> DataFrame:
    return table(spark, sf, "conversations").filter(F.length("text") > 0).select(F.lit(1).alias("edition_id"), (F.col("conv_id") + 1).cast("int").alias("surah"), (F.col("turn") + 1).cast("int").alias("ayah"), "text", (F.col("conv_id") + 1).cast("int").alias("page"))


#: Words of the made-up edition with their places, and its lines of eight words, numbered in each page.
EDITION_SQL = """
WITH t AS (SELECT CAST(conv_id AS INTEGER) + 1 AS surah, CAST(turn AS INTEGER) + 1 AS ayah, list_filter(regexp_split_to_array(text, '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '') AS ws FROM conversations),
u AS (SELECT surah, ayah, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM t),
w AS (SELECT *, row_number() OVER (ORDER BY surah, ayah, i) - 1 AS pos FROM u),
l AS (SELECT surah, ayah, (i - 1) // 8 AS part, min(pos) AS a, max(pos) AS b, min(i) AS i, max(i) AS j, arg_min(word, i) AS first_word, arg_max(word, i) AS last_word FROM w GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY surah ORDER BY ayah, part) AS line FROM l)
"""


def _chunks(spark, sf) -> DataFrame:
    """The edition's lines with their words, those from ``i`` to ``j`` of a verse, numbered within pages. Verses are dealt by
    chapter, which is a page, once for all branches, and cut into lines where they then are."""
    split = _verses(spark, sf).select("edition_id", "page", "surah", "ayah", T.tokens(F.col("text")).alias("words"))
    # the page is a value, as a join's filter on a key would part the branches' exchanges
    verses = split.repartition("surah").groupBy("edition_id", "surah", "ayah").agg(F.first("page").alias("page"), F.collect_list("words").alias("rows"))
    # each place of a verse with its words: one, or those of all rows of the verse
    shared = F.transform(F.sequence(F.lit(1), F.array_max(F.transform("rows", F.size))), lambda i: F.array_join(F.array_sort(F.transform(F.filter("rows", lambda w: F.size(w) >= i), lambda w: F.element_at(w, i))), " "))
    whole = F.when(F.size("rows") == 1, F.col("rows")[0]).when(F.array_max(F.transform("rows", F.size)) > 0, shared)
    lines = verses.select("edition_id", "page", "surah", "ayah", whole.alias("words"))
    lines = lines.select("edition_id", "page", "surah", "ayah", F.size("words").alias("n"), F.posexplode(S.blocks("words", 8)).alias("part", "words"))
    lines = lines.withColumn("i", (F.col("part") * 8 + 1).cast("long")).withColumn("j", F.least(F.col("part") * 8 + 8, "n").cast("long")).drop("n")
    return S.ordinal(lines, ["edition_id", "surah"], ["ayah", "part"], "line")


def _printed(spark, sf) -> DataFrame:
    """The edition's lines, numbered within pages; no digits, as these would be verse markers."""
    return _chunks(spark, sf).select("edition_id", "page", "surah", "ayah", "part", F.array_join("words", " ").alias("text"), "line")


def _edition_lines(spark, sf) -> DataFrame:
    """The edition's lines with their first and last words as ends."""
    end = lambda word, k: F.struct("surah", "ayah", word.alias("word"), F.col(k).alias("wordIndex"))
    first, last = F.substring_index(F.element_at("words", 1), " ", 1), F.substring_index(F.element_at("words", -1), " ", -1)
    rows = _chunks(spark, sf).withColumn("f", end(first, "i")).withColumn("e", end(last, "j"))
    return rows.select("edition_id", "page", "surah", "line", align_exact.word_endpoint("f").alias("first_word"), align_exact.word_endpoint("e").alias("end_word"))


@query(EDITION_SQL + "SELECT CAST(surah AS BIGINT) AS page, line, CAST(ayah AS BIGINT) AS ayah, first_word, CAST(i AS BIGINT) AS first_index, last_word, CAST(j AS BIGINT) AS last_index FROM n WHERE regexp_matches(first_word, '.')")
def exact_alignment(spark, sf):
    """The lines as printed text, aligned with the word stream of the verses."""
    plain = lambda df: df.withColumn("text", F.translate("text", "0123456789", "abcdefghij"))
    segs, ends = lines_of.segments(plain(_printed(spark, sf)))
    lines, _ = align_exact.align(segs, ends, words_of.words(plain(_verses(spark, sf))), LayoutSpec())
    back = _edition_lines(spark, sf).select("page", "line", F.col("first_word.word").alias("f"), F.col("end_word.word").alias("e"))
    out = lines.join(back, ["page", "line"])
    bare = lambda c: F.translate(c, "0123456789", "abcdefghij")
    alike = lambda a, b: (a == b) | (T.canonical_loose(a) == T.canonical_loose(b))
    same = alike(bare("f"), F.col("first_word.word")) & alike(bare("e"), F.col("end_word.word"))
    return out.filter(same).select(big("page").alias("page"), big("line").alias("line"), big("first_word.ayah").alias("ayah"), F.col("f").alias("first_word"), big("first_word.wordIndex").alias("first_index"), F.col("e").alias("last_word"), big("end_word.wordIndex").alias("last_index"))


@query(EDITION_SQL + """, k AS (SELECT * FROM n WHERE (surah * 31 + line) % 7 <> 0), b AS (SELECT *, lag(b, 1, -1) OVER (ORDER BY surah, line) AS before, lead(surah) OVER (ORDER BY surah, line) AS next FROM k)
SELECT 'continuity' AS rule, '1:' || surah || ':' || line AS key, before || '>' || a AS detail FROM b WHERE a <> before + 1
UNION ALL SELECT 'last_word', '1:' || surah || ':' || line, CAST(b AS VARCHAR) FROM b WHERE next IS NULL AND b <> (SELECT max(pos) FROM w)
""")
def layout_continuity(spark, sf):
    """The edition's lines, of which every seventh is missing."""
    stream = words_of.numbered_tokens(_verses(spark, sf), "text", "edition_id", "surah", "ayah")
    stream = S.prefix_sum(stream, F.lit(1), ["edition_id"], "surah", ["ayah", "word_no"], "pos").select("edition_id", "surah", "ayah", F.col("word_no").alias("wordIndex"), "word", T.canonical(F.col("word")).alias("canonical"), "pos")
    return checks.continuity(_edition_lines(spark, sf).filter("(page * 31 + line) % 7 <> 0"), stream)


@query(EDITION_SQL + """, z AS (SELECT surah, ayah, max(i) AS size FROM w GROUP BY ALL)
SELECT 'word_index' AS rule, '1:' || n.surah || ':' || line || ':end' AS key, last_word AS detail FROM n JOIN z USING (surah, ayah) WHERE line % 5 = 0 AND j + 3 > size
UNION ALL SELECT 'endpoint_verse', '1:' || surah || ':' || line || ':first', first_word FROM n WHERE line % 5 = 1
UNION ALL SELECT 'endpoint_fields', '1:' || surah || ':' || line || ':first', '' FROM n WHERE line % 5 = 2
UNION ALL SELECT 'marker_number', '1:' || surah || ':' || line || ':end', '' FROM n WHERE line % 5 = 3
UNION ALL SELECT 'endpoint_type', '1:' || surah || ':' || line || ':end', last_word FROM n WHERE line % 5 = 4
UNION ALL SELECT 'word_text', '1:' || n.surah || ':' || line || ':end', last_word FROM n JOIN z USING (surah, ayah) JOIN w ON w.surah = n.surah AND w.ayah = n.ayah AND w.i = n.j + 3 WHERE line % 5 = 0 AND j + 3 <= size AND strip_accents(word) <> strip_accents(last_word)
""")
def layout_endpoints(spark, sf):
    """The edition's lines with one fault in each, by the line's number."""
    k = F.col("line") % 5
    off = lambda e, **over: F.struct(*[over.get(f, F.col(f"{e}.{f}")).alias(f) for f in ("type", "surah", "ayah", "word", "wordIndex", "number")])
    first = F.when(k == 1, off("first_word", ayah=F.lit(9999))).when(k == 2, off("first_word", word=F.lit(None).cast("string"))).otherwise(F.col("first_word"))
    last = F.when(k == 0, off("end_word", wordIndex=F.col("end_word.wordIndex") + 3)).when(k == 3, off("end_word", type=F.lit("ayah_marker"), word=F.lit(None).cast("string"), number=F.col("end_word.ayah") + 1)).when(k == 4, off("end_word", type=F.lit("other"))).otherwise(F.col("end_word"))
    stream = words_of.numbered_tokens(_verses(spark, sf), "text", "edition_id", "surah", "ayah")
    stream = S.prefix_sum(stream, F.lit(1), ["edition_id"], "surah", ["ayah", "word_no"], "pos").select("edition_id", "surah", "ayah", F.col("word_no").cast("int").alias("wordIndex"), "word", T.canonical(F.col("word")).alias("canonical"), "pos")
    return checks.endpoints(_edition_lines(spark, sf).withColumn("first_word", first).withColumn("end_word", last), stream)


@query(EDITION_SQL + """SELECT page, coalesce(n_lines, 0) AS n_lines, coalesce(chapters, '') AS chapters, coalesce(ends, '') AS ends FROM (SELECT unnest(generate_series(1, (SELECT max(surah) FROM n))) AS page)
LEFT JOIN (SELECT surah AS page, count(*) AS n_lines, CAST(surah AS VARCHAR) AS chapters, string_agg(first_word || '/' || last_word, ',' ORDER BY line) AS ends FROM n GROUP BY surah) USING (page)
""")
def page_records(spark, sf):
    lines = _edition_lines(spark, sf)
    out = rollup.page_records(lines, lines.select("edition_id", "page", "surah").distinct(), LayoutSpec())
    ends = F.array_join(F.transform("lines", lambda x: F.concat_ws("/", x["first_word"]["word"], x["end_word"]["word"])), ",")
    return out.select(big("page").alias("page"), big(F.size("lines")).alias("n_lines"), F.array_join(F.col("surah_ids").cast("array<string>"), ",").alias("chapters"), ends.alias("ends"))


# lines of kinds, by the turn


@query(f"""
WITH t AS (SELECT conv_id + 1 AS page, turn + 1 AS line, CASE WHEN turn = 0 THEN 'heading' WHEN turn = 1 THEN 'opening' ELSE 'text' END AS kind, CASE WHEN turn = 0 THEN 'c' || conv_id END AS name FROM conversations),
s AS (SELECT *, CAST(count_if(kind = 'heading') OVER (ORDER BY page, line ROWS UNBOUNDED PRECEDING) AS BIGINT) AS surah FROM t)
SELECT page, line, kind, surah, name, CASE WHEN kind = 'text' THEN CAST(count_if(kind = 'text') OVER (PARTITION BY page ORDER BY line ROWS UNBOUNDED PRECEDING) AS BIGINT) END AS number FROM s
""")
def line_kinds(spark, sf):
    """Conversations as pages whose first line is a heading and whose second the opening formula."""
    turn = F.col("turn")
    text = F.when(turn == 0, F.concat(F.lit(f" {T.HEADING} c"), "conv_id")).when(turn == 1, F.lit(T.OPENING)).otherwise(F.concat(F.lit("x"), "text"))
    printed = table(spark, sf, "conversations").select(F.lit(1).alias("edition_id"), (F.col("conv_id") + 1).cast("int").alias("page"), (turn + 1).cast("int").alias("line_in_page"), text.alias("text"))
    rows = lines_of.classified(printed, LayoutSpec())
    names = lines_of.chapters(rows).select("surah", F.col("surahName").alias("name"))
    numbers = lines_of.numbered(rows).select("page", "line_in_page", F.col("line").alias("number"))
    named = rows.join(names.withColumn("kind", F.lit("heading")), ["surah", "kind"], "left").join(numbers, ["page", "line_in_page"], "left")
    return named.select(big("page").alias("page"), big("line_in_page").alias("line"), "kind", big("surah").alias("surah"), "name", big("number").alias("number"))


@query("SELECT 'text_before_heading' AS rule, '1:' || conv_id + 1 || ':' || turn + 1 AS key, 'x' || turn AS detail FROM conversations WHERE conv_id < (SELECT min(conv_id) FROM conversations WHERE conv_id % 5 = 3) UNION ALL SELECT 'chapter_count', '1', 'headings: ' || count(*) FROM conversations WHERE turn = 0 AND conv_id % 5 = 3 HAVING count(*) <> 114")
def line_violations(spark, sf):
    """Only every fifth conversation starts with a heading."""
    turn = F.col("turn")
    text = F.when((turn == 0) & (F.col("conv_id") % 5 == 3), F.concat(F.lit(f"{T.HEADING} c"), "conv_id")).otherwise(F.concat(F.lit("x"), turn))
    printed = table(spark, sf, "conversations").select(F.lit(1).alias("edition_id"), (F.col("conv_id") + 1).cast("int").alias("page"), (turn + 1).cast("int").alias("line_in_page"), text.alias("text"))
    spec = LayoutSpec()
    return lines_of.line_violations(lines_of.classified(printed, spec), spec)


@query("""
WITH t AS (SELECT conv_id + 1 AS page, turn + 1 AS line, turn FROM conversations),
p AS (SELECT page, line, unnest([0, 1]) AS seg FROM t)
SELECT page, line, CAST(seg AS BIGINT) AS seg, CASE WHEN seg = 0 THEN 'ab' ELSE 'cd' END AS text, CASE WHEN seg = 0 THEN line * 3 END AS marker FROM p
""")
def marker_segments(spark, sf):
    """A line of two words, a verse number behind one of them, and a word."""
    lines = table(spark, sf, "conversations").select(F.lit(1).alias("edition_id"), (F.col("conv_id") + 1).cast("int").alias("page"), (F.col("turn") + 1).cast("int").alias("line"), F.lit(1).alias("surah"))
    segs, _ = lines_of.segments(lines.withColumn("text", F.concat(F.lit("a  b"), F.col("line") * 3, F.lit(f" {T.RUB}cd"))))
    return segs.select(big("page").alias("page"), big("line").alias("line"), big("seg").alias("seg"), "text", big("marker").alias("marker"))


# mappings: customers as verses of an edition whose chapters are nations


def _customer_mapping(spark, sf) -> DataFrame:
    key = F.col("c_custkey").cast("int")
    own = table(spark, sf, "customer").select(F.lit(2).alias("edition_id"), (F.col("c_nationkey") + 1).cast("int").alias("surah"), key.alias("ayah"), (key % 40 + 1).alias("hafs_ayah"))
    other = table(spark, sf, "supplier").select(F.lit(1).alias("edition_id"), (F.col("s_nationkey") + 1).cast("int").alias("surah"), F.col("s_suppkey").cast("int").alias("ayah"), F.when(F.col("s_suppkey") % 3 == 0, F.lit(7)).otherwise(F.col("s_suppkey")).cast("int").alias("hafs_ayah"))
    return own.unionByName(other)


MAPPING_SQL = """
WITH m AS (SELECT 2 AS e, c_nationkey + 1 AS s, c_custkey AS a, c_custkey % 40 + 1 AS r FROM customer
UNION ALL SELECT 1, s_nationkey + 1, s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 7 ELSE s_suppkey END FROM supplier)
"""


@query(MAPPING_SQL + """, c AS (SELECT n_nationkey + 1 AS s, 20 + n_nationkey AS n FROM nation), x AS (SELECT e, s, unnest(generate_series(1, CAST(n AS BIGINT))) AS r FROM (SELECT DISTINCT e FROM m), c),
want AS (SELECT * FROM x WHERE NOT (s = 1 AND r = 1 AND e <> 1)), have AS (SELECT DISTINCT e, s, r FROM m)
SELECT 'missing_reference' AS rule, e || ':' || s || ':' || r AS key, '' AS detail FROM (SELECT * FROM want EXCEPT SELECT * FROM have)
UNION ALL SELECT 'extra_reference', e || ':' || s || ':' || r, '' FROM (SELECT * FROM have EXCEPT SELECT * FROM want)
""")
def mapping_coverage(spark, sf):
    counts = table(spark, sf, "nation").select((F.col("n_nationkey") + 1).cast("int").alias("surah"), (F.col("n_nationkey") + 20).alias("n"))
    return checks.mapping_coverage(_customer_mapping(spark, sf), counts)


@query(MAPPING_SQL + """
SELECT 'identity' AS rule, e || ':' || s || ':' || a AS key, CAST(r AS VARCHAR) AS detail FROM m WHERE e = 1 AND a <> r
UNION ALL SELECT 'mapped_verses', CAST(e AS VARCHAR), coalesce(CAST(n AS VARCHAR), '') FROM (VALUES (1, 100), (2, 99), (3, 5)) w(e, want) LEFT JOIN (SELECT e, count(DISTINCT (s, a)) AS n FROM m GROUP BY e) USING (e) WHERE n IS DISTINCT FROM want
""")
def mapping_totals(spark, sf):
    rows = _customer_mapping(spark, sf)
    editions = spark.createDataFrame([(1, 100), (2, 99), (3, 5)], "edition_id int, ayah_count bigint")
    return checks.mapping_identity(rows).unionByName(checks.mapping_complete(rows, editions))


@query(MAPPING_SQL + """, w(e, s, a, want) AS (VALUES (1, 1, 1, '1'), (2, 4, 3, '4'), (2, 1, 7, '8'), (9, 9, 9, '9'), (1, 3, 2, '2'))
SELECT 'anchor' AS rule, e || ':' || s || ':' || a AS key, coalesce(have, '') AS detail FROM w LEFT JOIN (SELECT e, s, a, array_to_string(list_sort(list(DISTINCT r)), ',') AS have FROM m GROUP BY ALL) USING (e, s, a) WHERE have IS DISTINCT FROM want
""")
def mapping_anchors(spark, sf):
    return checks.mapping_anchors(_customer_mapping(spark, sf), ((1, 1, 1, (1,)), (2, 4, 3, (4,)), (2, 1, 7, (8,)), (9, 9, 9, (9,)), (1, 3, 2, (2,))))


@query("SELECT 'missing_edition' AS rule, v.k AS key, '' AS detail FROM (VALUES ('1:hafs-6236:hafs:6236:hafs-kufi'), ('2:warsh-6213:warsh:6213:hafs-kufi'), ('3:qalun-6214:qalun:6214:hafs-kufi'), ('4:douri-6217:douri:6217:hafs-kufi')) v(k) UNION ALL SELECT 'extra_edition', r_regionkey || ':' || r_name || ':' || r_name || ':5:' || r_name, '' FROM region")
def editions_equal(spark, sf):
    """Regions as editions: none is what it should be."""
    name = F.col("r_name")
    return checks.editions_equal(table(spark, sf, "region").select(F.col("r_regionkey").alias("edition_id"), name.alias("edition_key"), name.alias("rawi"), F.lit(5).alias("ayah_count"), name.alias("reference")))


@query("SELECT 'digest' AS rule, CAST(doc_id AS VARCHAR) AS key, sha256(text) AS detail FROM documents WHERE doc_id % 4 = 1 UNION ALL SELECT 'missing_source', 'n' || doc_id, '' FROM documents WHERE doc_id % 4 = 2")
def file_digests(spark, sf):
    """Documents as files, a fourth of which has another digest and a fourth another name than it should."""
    docs, k = table(spark, sf, "documents"), F.col("doc_id") % 4
    have = docs.select(F.col("doc_id").cast("string").alias("name"), T.sha256(F.col("text")).alias("sha256"))
    want = docs.select(F.when(k == 2, F.concat(F.lit("n"), "doc_id")).otherwise(F.col("doc_id").cast("string")).alias("name"), T.sha256(F.when(k == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text"))).alias("sha256"))
    return checks.digests(have, want)
