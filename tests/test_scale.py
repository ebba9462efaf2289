"""What larger tables ask of the queries: no step that grows faster than its input, no task that takes a table whole."""

from quire.plans import catalogue


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_candidates_compare_names_once_and_in_all_tasks(spark, tmp_path):
    names = ["hot ring", "old ring", "hot pin", "hot ring", "a", "", None]
    rows = [(k, names[k % 7], f"b{k % 2}" if k % 11 else None, k % 3) for k in range(300)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    got = catalogue.fuzzy_candidates(spark, str(tmp_path))
    plan = plan_of(got)
    assert plan.count("ShuffledHashJoin") == 2 and "HashAggregate" in plan  # names with names, parts with parts

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, d in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
        return row[-1]

    want = {
        (a[0], b[0], d) for a in rows for b in rows
        if a[0] < b[0] and None not in (a[1], b[1], a[2], b[2]) and a[2:] == b[2:] and (d := distance(a[1], b[1])) <= max(2, min(6, len(a[1]) // 4))
    }
    out = got.collect()
    assert len(out) == len(want) and {tuple(r) for r in out} == want


def test_pages_read_their_sources_once(spark):
    """Lines and segments are read by one scan each, however many branches use them."""
    from quire.operators import pages
    from quire.spec import LayoutSpec

    lines = spark.createDataFrame([(e, k, f"a{k} b  ") for e in (1, 2) for k in range(40)] + [(1, 7, " \x1c"), (None, 3, "x")], "edition_id int, line_no int, text string")
    segments = spark.createDataFrame([(e, s, "".join(f"<p>a{k}b</p>" for k in range(s * 15, min(40, s * 15 + 15)))) for e in (1, 2) for s in range(3)], "edition_id int, segment_no int, xml string")
    printed, bad = pages.printed_pages(lines, segments, LayoutSpec(max_lines=15))
    plan = plan_of(printed.drop("line_in_page"))
    assert "InMemoryTableScan" in plan and len(printed.held) == 3
    assert sorted(map(tuple, printed.collect())) == [(e, k // 15 + 1, k % 15 + 1, f"a{k} b") for e in (1, 2) for k in range(40)]
    assert [tuple(r) for r in bad.collect()] == [("unconsumed_line", "3", "x")]
    for df in printed.held:
        df.unpersist()


def test_white_space_and_marks_are_the_same_sets(spark):
    """The classes are written for speed: they hold what the plain ones hold, in all of Unicode."""
    from pyspark.sql import functions as F

    from quire.functions import text as T

    plain = r"[\s\x1C-\x1F\x85   -     　]"
    marks = r"[\p{Mn}࢘-࢟࣊-࣒]"
    dropped = rf"[\p{{Mn}}\p{{Cf}}{T.TATWEEL}۝۞ۥۦ۩࢘-࢟࣊-࣒]"
    every = spark.createDataFrame([(c, chr(c)) for c in range(0x110000) if not 0xD800 <= c < 0xE000], "c int, x string")
    x = F.col("x")
    odd = every.filter((x.rlike(plain) != x.rlike(T.SPACE)) | (x.rlike(marks) != x.rlike(T.MARKS)) | (x.rlike(dropped) != x.rlike(T.DROPPED)) | (T.has_text(x) == x.rlike(plain)))
    assert odd.count() == 0 and every.filter(x.rlike(T.SPACE)).count() == 29


def test_tokens_without_digits_take_one_test(spark):
    """Words without digits are told first, before the patterns of numbers in front and behind; results stay."""
    from pyspark.sql import functions as F

    from quire.functions import text as T

    df = spark.createDataFrame([("ab",), ("12",), ("3x",), ("x٣",), (" ",), (None,)], "w string").select(T.split_token(F.col("w")).alias("p"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("NOT RLIKE(") < plan.index("regexp_extract") if "NOT RLIKE(" in plan else plan.index("NOT ") < plan.index("regexp_extract")
    assert [[tuple(x) for x in r.p] for r in df.collect()] == [[("ab", None)], [("", 12)], [("", 3), ("x", None)], [("x", None), ("", 3)], [], []]


def test_roll_up_of_repeated_orders_and_lines(spark, tmp_path):
    """Lines meet their orders when they are rolled up; orders and lines that repeat, and nulls, count as in the join."""
    spark.createDataFrame([(k,) for k in (1, 2, 2, 3, None)], "o_orderkey long").write.parquet(str(tmp_path / "orders.parquet"))
    lines = [(1, 5), (1, 5), (1, 6), (2, None), (2, 4), (4, 1), (None, 1)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = catalogue.group_minmax_rollup(spark, str(tmp_path))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate [l_orderkey")  # the join takes aggregates
    assert sorted(map(tuple, got.collect())) == [(1, 3, 2, 5, 6, 16), (2, 4, 1, 4, 4, 8)]


def test_words_do_not_carry_their_segments(spark, tmp_path):
    """A segment's text is no column of its words' rows in the as-of join."""
    rows = [(1, 0, "ab  c"), (1, 1, " "), (1, 2, "d\ne f"), (2, 0, "x"), (2, 1, None), (None, 0, "g h")]
    spark.createDataFrame(rows, "conv_id long, turn long, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = catalogue.offset_join_exact(spark, str(tmp_path))
    windows = [line for line in got._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window [last(" in line]
    assert windows and not any("seg" in line for line in windows)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, 0, 2, True), (1, 2, 3, True), (2, 0, 1, True), (None, 0, 2, True)], key=repr)
    whole = got._jdf.queryExecution().optimizedPlan().toString()
    assert not any("seg#" in line and "_found" in line for line in whole.split("\n"))


def test_mapping_rules_take_one_pass_by_chapter(spark, tmp_path):
    """Repeats go, references are rolled up and neighbours compared behind one exchange, in more tasks than a shuffle has by default."""
    rows = [(1, 1, 5), (1, 1, 5), (1, 2, 3), (1, 2, 9), (1, 3, 9), (2, 1, 4), (None, 1, 7), (None, 2, 6)]
    spark.createDataFrame([(o, n, p) for o, n, p in rows], "l_orderkey long, l_linenumber int, l_partkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = catalogue.contiguous_monotone(spark, str(tmp_path))
    plan = plan_of(got)
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1 and "hashpartitioning(surah#" in plan and ", 4)" not in plan
    assert sorted(map(tuple, got.collect())) == [("reference_gap", "2:1:2", "3:9"), ("reference_order", "2:1:2", "5:3"), ("reference_order", "2:2", "7:6")]


def test_alignment_makes_words_and_lines_once(spark, tmp_path):
    """The word stream and the lines are read, split and dealt once each, whatever sums and joins follow."""
    rows = [(0, 0, "a b c d e f g h i"), (0, 1, None), (0, 2, " j  1k "), (1, 0, "ء l"), (1, 1, "m\nn " * 40), (2, 0, "")]
    spark.createDataFrame(rows, "conv_id long, turn long, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = catalogue.exact_alignment(spark, str(tmp_path))
    want = [(1, 1, 1, "a", 1, "h", 8), (1, 2, 1, "i", 9, "i", 9), (1, 3, 3, "j", 1, "1k", 2), (2, 1, 1, "ء", 1, "l", 2)]
    assert sorted(map(tuple, got.collect())) == want + [(2, k + 2, 2, "m", 8 * k + 1, "n", 8 * k + 8) for k in range(10)]
    final = plan_of(got).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 2


def test_blocks_of_arrays(spark):
    """Blocks are cut by their items alone; an empty array has none."""
    from pyspark.sql import functions as F

    from quire.operators.streams import blocks

    df = spark.createDataFrame([(list(range(n)),) for n in (0, 1, 3, 4, 9)], "x array<int>")
    assert [r.b for r in df.select(blocks("x", 4).alias("b")).collect()] == [None, [[0]], [[0, 1, 2]], [[0, 1, 2, 3]], [[0, 1, 2, 3], [4, 5, 6, 7], [8]]]


def test_repeated_lines_have_their_own_segments(spark, tmp_path):
    """A line's segments come from its own text, also where the table repeats a row."""
    spark.createDataFrame([(0, 0), (0, 0), (1, 2)], "conv_id long, turn long").write.parquet(str(tmp_path / "conversations.parquet"))
    got = catalogue.marker_segments(spark, str(tmp_path))
    assert "Exchange" not in plan_of(got)
    assert sorted(map(tuple, got.collect())) == [(1, 1, 0, "ab", 3)] * 2 + [(1, 1, 1, "cd", None)] * 2 + [(2, 3, 0, "ab", 9), (2, 3, 1, "cd", None)]


def test_pages_hold_no_texts(spark):
    """What is held is numbers of segments and runs. Segments that span parts of lines, lines behind the last segment, empty
    segments, lines of equal number and editions without segments keep their places."""
    from quire.operators import pages
    from quire.spec import LayoutSpec

    sizes = {1: [700, 3, 0, 20, 0, 600], 2: [0, 1], 3: [2], 5: [4]}
    lines = [(e, k, f"{e}x{k}y ") for e, own in sizes.items() for k in range(sum(own) + (e == 3) * 5)] + [(4, 0, "q")]
    text, segments = {(e, k): t for e, k, t in lines}, []
    for e, own in sizes.items():
        for s, n in enumerate(own):
            at = sum(own[:s])
            segments.append((e, s, "".join(f"<p>{text[e, k].strip()}</p>" for k in range(at, at + n))))
    lines += [(6, 0, t) for t in ("aa", "b", "cccc")]  # by any order one segment
    segments += [(6, 0, "<p>aabcccc</p>")]
    printed, bad = pages.printed_pages(spark.createDataFrame(lines, "edition_id int, line_no int, text string").repartition(3), spark.createDataFrame(segments, "edition_id int, segment_no int, xml string"), LayoutSpec(max_lines=10))
    assert not [c for df in printed.held for c, kind in df.dtypes if kind == "string"]
    want = []
    for e, own in sizes.items():
        before, at = 0, 0
        for s, n in enumerate(own):
            n += (e == 3) * 5  # lines behind all segments are the last one's
            want += [(e, before + (k // 10 if n > 10 else 0) + 1, k % 10 + 1, text[e, at + k].strip()) for k in range(n)]
            before, at = before + max(1, -(-n // 10)), at + n
    got = sorted(map(tuple, printed.collect()))
    assert [r for r in got if r[0] < 6] == sorted(want)
    assert [r[:3] for r in got if r[0] == 6] == [(6, 1, 1), (6, 1, 2), (6, 1, 3)] and {r[3] for r in got if r[0] == 6} == {"aa", "b", "cccc"}
    found = [r for r in sorted(map(tuple, bad.collect())) if not r[1].startswith("6:")]
    assert found == [("text_page_mismatch", "3:0", "lines: 7"), ("unconsumed_line", "4:0", "q")]
    for df in printed.held:
        df.unpersist()


def test_lines_of_signs_alone_do_not_count(spark, tmp_path):
    """Lines that are empty without the signs of tags are no lines, as in the SQL; documents of one id are one edition."""
    import duckdb

    texts = ["\n".join(f"a{k}" if k % 7 else "<>" for k in range(70)), "\n".join(["<", "b > c ", ""] * 20), "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, catalogue.printed_pages(spark, str(tmp_path)).collect()))
    bad = sorted(map(tuple, catalogue.page_break_violations(spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(con.execute(catalogue.ORACLES["printed_pages"]).fetchall()) and len(got) == 80
    assert bad == sorted(con.execute(catalogue.ORACLES["page_break_violations"]).fetchall())
    repeated = spark.createDataFrame([(1, f"{x}\n" * 40) for x in ("longer line", "s", "mid")] + [(1, None)], "doc_id long, text string")
    repeated.write.mode("overwrite").parquet(str(tmp_path / "again" / "documents.parquet"))
    pages = catalogue.printed_pages(spark, str(tmp_path / "again")).groupBy("page").count().collect()
    assert sorted(map(tuple, pages)) == [(k, 15) for k in range(1, 9)]
    assert catalogue.page_break_violations(spark, str(tmp_path / "again")).collect() == []
