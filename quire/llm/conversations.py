"""Repair of conversations: faults of turns, and the cheapest edits that restore the order of roles.

A conversation's rows are in the order of turn (nulls first), role and text. A row's first fault counts: it is blank (no
character but ASCII white space), a duplicate (of an earlier row's role and text) or truncated (its last other character is no
full stop, exclamation or question mark). Edits go from row to row: Keep, Rerole to user or assistant (3), Delete (4; blank
rows and duplicates must go), and Insert an empty row of user or assistant anywhere (3); a truncated row that stays adds 3.
The roles' initials must then follow a grammar of four states: nothing yet, after a system's row, after a user's, after an
assistant's. A backward pass gives every row and state its cost to go; a forward walk takes, of the edits that cost just what
is left, the one whose initial is least in ASCII. As an initial leads to one state alone, the walk's string is the least.

Conversations may hold any share of all rows. Rows are sorted by ranges and cut into blocks of BLOCK rows or BYTES bytes at most. A
conversation that lies whole inside a range and a block is done at once. For the others a block's costs from each state to
each are a matrix of least sums, of which a backward scan makes the costs after every block; a last pass walks the blocks in
order. Only that pass takes a conversation's rows to one task, as its digest is sequential: a block at a time, in bounded
memory. Rows that repeat as a whole are one row with a count from the start.

Null ids form a conversation of their own; a null turn, role or text reads as one space (a null turn stays null in the order
and the gaps). Conversations that lose all rows have zeros, an empty audit and the digest of the empty string. Empty tables give
no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import drop_since, mark, small_batches, tidied, write_table

#: Rows and bytes of text of a block, at most (but for one longer row).
BLOCK, BYTES = 256, 1 << 20
#: Characters of a role and a text by which ranges are cut; a sample of them goes to the driver.
HEAD = 64
#: Salts of the join that finds a block's rows that an earlier block has.
SALTS = 16

INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
NEVER = 1 << 60
#: States: nothing yet, after s, after u, after a; what each initial makes of each.
NEXT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
#: The role, and the state after it, that Insert and Rerole give in each state.
GIVEN = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
LEGAL = {"su", "ua", "au"}
SPACE = " \t\n\x0b\x0c\r"

ROW = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("n", pa.int64())])
TURN = pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
RESULT_TYPES = [pa.int64()] * 6 + [pa.string()] * 2
RESULT_DDL = ", ".join(f"{c} {'bigint' if t == pa.int64() else 'string'}" for c, t in zip(RESULT, RESULT_TYPES, strict=True))
TURNS_DDL = "turns array<struct<edit:string,role:string,text:string>>"

REPAIR_SQL = r"""
WITH RECURSIVE hexed(k, i, c) AS (SELECT range::BIGINT, 0, range::BIGINT FROM range(256) UNION ALL
  SELECT k, i + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM hexed WHERE i < 8),
crc AS (SELECT list(c ORDER BY k) AS t FROM hexed WHERE i = 8),
coded AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS code FROM conversations, crc),
damaged AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
  CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, code FROM coded WHERE code <> 0),
twice AS (SELECT conv_id, turn, role, text, unnest(CASE WHEN code = 3 THEN [1, 2] ELSE [1] END) AS copy FROM damaged),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
  regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending FROM twice),
told AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM numbered),
rows_ AS (SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
  left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS was FROM told),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (was IS NOT NULL AND was || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM rows_ GROUP BY conv_id),
walk(conv_id, i, g) AS (
  SELECT conv_id, n + 1, [{'c': 0::BIGINT, 'a': '', 'b': ''}, {'c': 6::BIGINT, 'a': 'II', 'b': chr(10) || 'user:' || chr(10) || 'assistant:'}, {'c': 3::BIGINT, 'a': 'I', 'b': chr(10) || 'assistant:'}, {'c': 0::BIGINT, 'a': '', 'b': ''}] FROM counted
  UNION ALL
  SELECT conv_id, i, [list_min([h[1], {'c': h[3].c + 3, 'a': 'I' || h[3].a, 'b': chr(10) || 'user:' || h[3].b}, {'c': h[4].c + 6, 'a': 'II' || h[4].a, 'b': chr(10) || 'user:' || chr(10) || 'assistant:' || h[4].b}]),
    list_min([h[2], {'c': h[3].c + 3, 'a': 'I' || h[3].a, 'b': chr(10) || 'user:' || h[3].b}, {'c': h[4].c + 6, 'a': 'II' || h[4].a, 'b': chr(10) || 'user:' || chr(10) || 'assistant:' || h[4].b}]),
    list_min([h[3], {'c': h[4].c + 3, 'a': 'I' || h[4].a, 'b': chr(10) || 'assistant:' || h[4].b}]),
    list_min([h[4], {'c': h[3].c + 3, 'a': 'I' || h[3].a, 'b': chr(10) || 'user:' || h[3].b}])]
  FROM (SELECT w.conv_id, r.i, list_transform([1, 2, 3, 4], lambda s: list_min(
      [{'c': g[s].c + 4, 'a': 'D' || g[s].a, 'b': g[s].b}]
      || CASE WHEN fault IN ('blank', 'duplicate') THEN [] ELSE [{'c': g[CASE s WHEN 3 THEN 4 ELSE 3 END].c + 3 + CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, 'a': 'R' || g[CASE s WHEN 3 THEN 4 ELSE 3 END].a,
        'b': chr(10) || CASE s WHEN 3 THEN 'assistant' ELSE 'user' END || ':' || text || g[CASE s WHEN 3 THEN 4 ELSE 3 END].b}] END
      || CASE WHEN fault NOT IN ('blank', 'duplicate') AND ((initial = 's' AND s = 1) OR (initial = 'u' AND s <> 3) OR (initial = 'a' AND s = 3)) THEN [{'c': g[CASE initial WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].c + CASE fault WHEN 'truncated' THEN 3 ELSE 0 END,
        'a': 'K' || g[CASE initial WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].a, 'b': chr(10) || role || ':' || text || g[CASE initial WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].b}] ELSE [] END)) AS h
    FROM walk w JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i - 1))
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
 coalesce(w.g[1].c, 0) AS cost, coalesce(w.g[1].a, '') AS audit, sha256(coalesce(substr(w.g[1].b, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN walk w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = 1
"""


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, n: the rows as a fault generator leaves them, by a hash of conversation and turn; n is how
    often a row is there, 0 for one that was dropped."""
    id_, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    spaced = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    code = F.crc32(F.concat(spaced(id_), F.lit(":"), spaced(turn)).cast("binary")) % 20
    rows = conversations.select(id_.alias("conv_id"), turn.alias("turn"), spaced(F.col("role")).alias("role"), spaced(F.col("text")).alias("text"), code.alias("code"))
    gone = F.col("code") == 0
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone, "").otherwise(text).alias("text"),
        F.when(gone, 0).when(F.col("code") == 3, 2).otherwise(1).cast("long").alias("n"),
    )


@dataclass
class Step:
    """Equal rows in a row: the first may stay unless ``forced``, ``copies`` rows go with it if it is."""

    role: str
    text: str
    forced: bool
    truncated: bool
    copies: int


def inserted(costs: list[int]) -> list[int]:
    """The costs when rows may be inserted first."""
    start, s, u, a = costs
    u, a = min(u, INSERT + a), min(a, INSERT + u)
    return [min(start, INSERT + u), min(s, INSERT + u), u, a]


#: The cost to go after the last row.
END = inserted([0, NEVER, NEVER, 0])


def edits(step: Step, state: int, after: list[int]) -> list[tuple[str, int, int]]:
    """(initial, cost to go, next state) of the edits of a row, by initials."""
    out = [("D", DELETE * step.copies + after[state], state)]
    if not step.forced:
        more, to = TRUNCATED * step.truncated, NEXT.get(step.role[:1], (None,) * 4)[state]
        if to is not None:
            out.append(("K", more + after[to], to))
        to = GIVEN[state][1]
        out.append(("R", REROLE + more + after[to], to))
    return out


def costs_to_go(steps: list[Step], after: list[int]) -> list[list[int]]:
    """For each step, and for the end, the cost to go from each state."""
    out = [after]
    for step in reversed(steps):
        out.append(inserted([min(e[1] for e in edits(step, g, out[-1])) for g in range(4)]))
    return out[::-1]


def matrix(steps: list[Step]) -> list[int]:
    """The least cost of the steps from each state to each, row by row."""
    columns = [costs_to_go(steps, [0 if h == g else NEVER for h in range(4)])[0] for g in range(4)]
    return [min(NEVER, columns[h][g]) for g in range(4) for h in range(4)]


@dataclass
class Repair:
    """A conversation's faults and repair, from its blocks in order."""

    gaps_known: bool = False
    low: int = 0
    high: int = 0
    distinct: int = 0
    last_turn: int | None = None
    last_initial: str | None = None
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    cost: int = 0
    state: int = 0
    audit: list[str] = field(default_factory=list)
    digest: object = field(default_factory=hashlib.sha256)
    written: bool = False

    def steps(self, rows: list[tuple], later: set[int]) -> list[Step]:
        """The steps of a block of (turn, role, text, n), whose rows ``later`` an earlier block has; counts their faults."""
        out, seen = [], set()
        for k, (turn, role, text, n) in enumerate(rows):
            if not n:
                continue
            if turn is not None:
                if not self.gaps_known:
                    self.gaps_known, self.low = True, turn
                self.distinct += turn != self.last_turn
                self.high = self.last_turn = turn
            initial = role[:1]
            if self.last_initial is not None:
                self.illegal += self.last_initial + initial not in LEGAL
            self.illegal += n - 1
            self.last_initial = initial
            plain = text.rstrip(SPACE)
            if not plain:
                self.blank += n
                out.append(Step(role, text, True, False, n))
                continue
            again = k in later or (role, text) in seen
            seen.add((role, text))
            self.duplicate += n - (not again)
            if not again:
                cut = plain[-1] not in ".!?"
                self.truncated += cut
                out.append(Step(role, text, False, cut, 1))
            if again or n > 1:
                out.append(Step(role, text, True, False, n if again else n - 1))
        return out

    def walk(self, steps: list[Step], after: list[int], last: bool) -> Iterator[tuple[str, str | None, str | None]]:
        """The edits of a block with the rows that they leave; of its ``last`` one the inserts at the end too."""
        to_go = costs_to_go(steps, after)
        for k, now in enumerate(to_go):
            ends = k == len(steps)
            if ends and not last:
                return
            while True:
                options = [] if ends else edits(steps[k], self.state, to_go[k + 1])
                role, to = GIVEN[self.state]
                options.append(("I", INSERT + now[to], to))
                tight = sorted(e for e in options if e[1] == now[self.state])
                if not tight or (ends and not now[self.state]):
                    break
                edit, left, to = tight[0]
                if edit == "I":
                    yield self.write("I", role, "")
                elif edit == "D":
                    self.audit.append("D" * steps[k].copies)
                    yield "D" * steps[k].copies, None, None
                else:
                    yield self.write(edit, steps[k].role if edit == "K" else role, steps[k].text)
                self.state = to
                if edit != "I":
                    break

    def write(self, edit: str, role: str, text: str) -> tuple[str, str, str]:
        self.audit.append(edit)
        self.digest.update((("\n" if self.written else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.written = True
        return edit, role, text

    def result(self) -> tuple:
        gaps = min(self.high - self.low + 1 - self.distinct, 2**63 - 1) if self.gaps_known else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest()


def kept_turns(edits: Iterator[tuple]) -> list[dict]:
    return [{"edit": e, "role": role, "text": text} for e, role, text in edits if role is not None]


def whole(rows: list[tuple], with_turns: bool) -> tuple[tuple, list[dict] | None]:
    """(result, turns) of a conversation of one block."""
    repair = Repair()
    steps = repair.steps(rows, set())
    repair.cost = costs_to_go(steps, END)[0][0]
    turns = kept_turns(repair.walk(steps, END, True))
    return repair.result(), turns if with_turns else None


def sorted_blocks(rows: DataFrame, with_turns: bool) -> DataFrame:
    """conv_id, part, block, with the result (and turns) of a conversation that is done, or the rows of a block of one that
    is not; written, as ranges may fall otherwise another time."""
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    head = lambda c: F.substring(c, 1, HEAD)
    ordered = counted.repartitionByRange("conv_id", "turn", head("role"), head("text")).sortWithinPartitions("conv_id", "turn", "role", "text")
    types = [pa.int64(), pa.int32(), pa.int32(), *RESULT_TYPES, pa.list_(TURN), pa.list_(ROW)]
    names = ["conv_id", "part", "block", *RESULT, "turns", "rows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out = TaskContext.get().partitionId(), []
        now, held, size, opened, block = None, [], 0, True, 0

        def given(least: int) -> Iterator[pa.RecordBatch]:
            if len(out) >= least:
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                out.clear()
                yield pa.RecordBatch.from_arrays(columns, names=names)

        def close(done: bool) -> None:
            nonlocal held, size, block
            if done:
                result, turns = whole(held, with_turns)
                out.append((now[0], part, block, *result, turns, None))
            else:
                out.append((now[0], part, block, *[None] * len(RESULT), None, [dict(zip(("turn", "role", "text", "n"), r, strict=True)) for r in held]))
            held, size, block = [], 0, block + 1

        for b in batches:
            for conv, turn, role, text, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now != (conv,):
                    if now is not None:
                        # a range's first conversation may have begun in the range before
                        close(not opened)
                        opened = False
                    now = (conv,)
                elif len(held) >= BLOCK or size > BYTES:
                    opened = True
                    close(False)
                    yield from given(16)
                held.append((turn, role, text, n))
                size += len(text)
            yield from given(256)
        if now is not None:
            close(False)
        yield from given(1)

    ddl = f"conv_id bigint, part int, block int, {RESULT_DDL}, {TURNS_DDL}, rows array<struct<turn:bigint,role:string,text:string,n:bigint>>"
    return write_table(ordered.select("conv_id", "turn", "role", "text", "n").mapInArrow(tidied(run), ddl), "conversation-blocks")


def later_rows(blocks: DataFrame) -> DataFrame:
    """part, block, later: the places of a block's rows that an earlier block of the conversation has."""
    rows = blocks.select("part", "block", "conv_id", F.posexplode("rows").alias("k", "row")).filter("row.n > 0")
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    digest = F.sha2(F.concat_ws(":", conv, F.octet_length("row.role"), F.concat("row.role", "row.text")).cast("binary"), 256)
    firsts = rows.select("part", "block", "k", digest.alias("digest")).groupBy("digest", "part", "block").agg(F.min("k").alias("k"))
    of_all = firsts.groupBy("digest").agg(F.min(F.struct("part", "block")).alias("first"), F.count("*").alias("times")).filter("times > 1")
    spread = of_all.select(F.col("digest"), "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    met = firsts.withColumn("salt", F.pmod(F.hash("part", "block"), F.lit(SALTS))).join(spread, ["digest", "salt"]).filter(F.struct("part", "block") != F.col("first"))
    return met.groupBy("part", "block").agg(F.collect_list("k").alias("later"))  # BLOCK places at most


def rows_of(column: pa.Array) -> Iterator[list[tuple]]:
    for rows in column.to_pylist():
        yield [(r["turn"], r["role"], r["text"], r["n"]) for r in rows]


def matrices(blocks: DataFrame) -> DataFrame:
    """conv_id, part, block, costs of the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            costs = [matrix(Repair().steps(rows, set(later or ()))) for rows, later in zip(rows_of(b.column(3)), b.column(4).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(costs, pa.list_(pa.int64()))], names=["conv_id", "part", "block", "costs"])

    return blocks.select("conv_id", "part", "block", "rows", "later").mapInArrow(tidied(run), "conv_id bigint, part int, block int, costs array<bigint>")


def costs_after(blocks: DataFrame) -> DataFrame:
    """part, block, after (the cost to go from each state after the block), before (that before it), last (whether it is its
    conversation's last). A backward scan of a row a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, after = None, END
        for b in batches:
            found = []
            for conv, costs in zip(b.column(0).to_pylist(), b.column(3).to_pylist(), strict=True):
                last = now != (conv,)
                now, after = (conv,), END if last else after
                before = [min(costs[4 * g + h] + after[h] for h in range(4)) for g in range(4)]
                found.append((after, before, last))
                after = before
            vectors = [pa.array([f[k] for f in found], pa.list_(pa.int64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns[1:3], *vectors, pa.array([f[2] for f in found], pa.bool_())], names=["part", "block", "after", "before", "last"])

    order = ["conv_id", F.desc("part"), F.desc("block")]
    rows = matrices(blocks).repartition("conv_id").sortWithinPartitions(*order)
    return rows.select("conv_id", "part", "block", "costs").mapInArrow(tidied(run), "part int, block int, after array<bigint>, before array<bigint>, last boolean")


def walked(blocks: DataFrame, with_turns: bool) -> DataFrame:
    """As the done rows of sorted_blocks(), for conversations of several blocks: a result at the last block, turns at each."""
    names = ["conv_id", "part", "block", *RESULT, "turns"]
    types = [pa.int64(), pa.int32(), pa.int32(), *RESULT_TYPES, pa.list_(TURN)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, repair = None, Repair()
        for b in batches:
            out = []
            columns = [b.column(k).to_pylist() for k in (0, 1, 2, 4, 5, 6, 7)]
            for rows, conv, part, block, later, after, before, last in zip(rows_of(b.column(3)), *columns, strict=True):
                if now != (conv,):
                    now, repair = (conv,), Repair(cost=before[0])
                turns = kept_turns(repair.walk(repair.steps(rows, set(later or ())), after, last))
                out.append((conv, part, block, *(repair.result() if last else [None] * len(RESULT)), turns if with_turns else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)] if out else [pa.array([], t) for t in types], names=names)

    rows = blocks.join(costs_after(blocks), ["part", "block"]).repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    return rows.select("conv_id", "part", "block", "rows", "later", "after", "before", "last").mapInArrow(tidied(run), f"conv_id bigint, part int, block int, {RESULT_DDL}, {TURNS_DDL}")


def worked(rows: DataFrame, with_turns: bool) -> DataFrame:
    spark, start = rows.sparkSession, mark()
    small_batches(spark)
    found = sorted_blocks(rows, with_turns)
    opened = found.filter("rows IS NOT NULL").select("conv_id", "part", "block", "rows")
    blocks = opened.join(later_rows(opened), ["part", "block"], "left")
    done = found.filter("rows IS NULL").drop("rows")
    out = write_table(done.unionByName(walked(blocks, with_turns)), "conversations-repaired")
    drop_since(spark, start, out)
    return out


def audited(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation of ``rows``
    (conv_id, turn, role, text, n)."""
    return worked(rows, False).filter("audit IS NOT NULL").select("conv_id", *RESULT)


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, place, edit, role, text: the rows that the cheapest repair leaves, in the order of place."""
    found = worked(rows, True).select("conv_id", F.struct("part", "block").alias("at"), F.posexplode("turns").alias("k", "turn"))
    return found.select("conv_id", F.struct("at.part", "at.block", "k").alias("place"), "turn.edit", "turn.role", "turn.text")


def counted_once(conversations: DataFrame) -> DataFrame:
    """Rows as they are, for audited() and repaired()."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), spaced("role"), spaced("text"), F.lit(1).cast("long").alias("n"))
