import unicodedata

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.functions.edits import opcodes
from quire.functions.unicode import nfd, nfkc

from .spec import model

CHARS = [*range(0x621, 0x64B), 0x64B, 0x652, 0x653, 0x654, 0x670, 0x671, 0x672, 0x6C0, 0x6C2, 0x6D3, 0x6DD, 0x6DE, 0x6E5, 0x6E6, 0x6E9, 0x640, 0x20, 0xA0, 0x200D, 0x898, 0x41, 0x660, 0x6F5]


def one(spark, f, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in rows.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_canonical_equals_the_model(spark):
    texts = [chr(c) for c in CHARS] + ["".join(chr(c) for c in CHARS), "وَمَا لِيَ", None, ""]
    assert one(spark, T.canonical, texts) == [model.canonical(t) for t in texts]
    assert one(spark, lambda c: T.canonical(nfd(c)), texts) == [model.canonical(t) for t in texts]


def test_composed_characters_and_presentation_forms(spark):
    """All of the first plane, but for Hangul, against the standard library's normal forms."""
    chars = [chr(c) for c in range(0x20, 0x10000) if not (0xAC00 <= c < 0xE000 or 0x1100 <= c < 0x1200 or unicodedata.category(chr(c)) in ("Cn", "Co"))]
    dropped = lambda x: unicodedata.category(x) in ("Mn", "Cf") or x in model.SIGNS or "\u0898" <= x <= "\u089f" or "\u08ca" <= x <= "\u08d2"
    want = ["".join({"ٱ": "ا", "ى": "ي"}.get(x, x) for x in unicodedata.normalize("NFD", c) if not dropped(x)) for c in chars]
    got = one(spark, T.canonical, chars)
    assert [(c, g, w) for c, g, w in zip(chars, got, want, strict=True) if g != w and len(w) == 1 and unicodedata.normalize("NFD", c) != c] == []
    arabic = [c for c in chars if "\u0600" <= c < "\u0900" or "\ufb50" <= c < "\ufe00" or "\ufe70" <= c < "\uff00"]
    folded = str.maketrans("ٱأإآٲٳٵىئؤءٶٸ", "اااااااييواوي")
    plain = ["".join(x for x in unicodedata.normalize("NFKC", c).translate(folded) if "\u0621" <= x <= "\u063a" or "\u0641" <= x <= "\u064a") for c in arabic]
    assert one(spark, T.mapping_normal, arabic) == plain
    assert one(spark, T.mapping_normal, ["\ufefbك", "ﷲ"]) == ["لاك", "الله"] and one(spark, T.canonical, ["café Ångström"]) == ["cafe Angstrom"]


def test_forms_differ(spark):
    hamza = ["ء", "ئ", "ؤ", "مَـٰ", "ٱلۡ أ"]
    assert one(spark, T.canonical, hamza) == ["ء", "ي", "و", "م", "ال ا"]
    assert one(spark, T.canonical_loose, hamza) == ["", "ي", "و", "م", "ال ا"]
    assert one(spark, T.fuzzy_canonical, hamza) == ["ء", "ء", "ء", "ما", "الا"]
    assert one(spark, T.mapping_normal, hamza) == ["ا", "ي", "و", "م", "الا"]
    assert one(spark, lambda c: T.mapping_normal(nfkc(c)), ["ﷲ", "ٶ", "ٸ"]) == ["الله", "و", "ي"]
    assert one(spark, T.structural, [" ٱلۡ \t أ ", None]) == ["ال ا", ""]


def test_tokens_and_markers(spark):
    got = one(spark, T.split_token, ["12", "١٢", "a1", "1a", "12ab34", "۞", " ۞a ", "", None, "a", "99999999999"])
    assert [[(p.token, p.marker) for p in r] for r in got] == [[("", 12)], [("", 12)], [("a", None), ("", 1)], [("", 1), ("a", None)], [("", 12), ("ab34", None)], [], [("a", None)], [], [], [("a", None)], [("", None)]]
    assert [[(p.token, p.marker) for p in r] for r in one(spark, lambda c: T.split_token(c, leading=False), ["12ab34"])] == [[("12ab", None), ("", 34)]]
    assert one(spark, T.tokens, ["a b  c\n", "", None, " "]) == [["a", "b", "c"], [], [], []]
    assert one(spark, T.digits_to_int, ["٣٤", "۳4", "x", "99999999999"]) == [34, 34, None, None]


def test_headings_and_formulas(spark):
    lines = [f"{T.HEADING} البقرة ", "سُورَةٌ أنزلناها", T.OPENING, f"{T.OPENING} ا", "بِسۡمِ ٱللَّهِ ٱلرَّحۡمَٰنِ ٱلرَّحِيمِ", None]
    assert one(spark, T.is_heading, lines) == [True, False, False, False, False, False]
    assert one(spark, T.heading_name, lines)[:2] == ["البقرة", None]
    assert one(spark, T.is_opening, lines) == [False, False, True, False, True, False]
    assert one(spark, T.starts_with_opening, lines) == [False, False, True, True, True, False]
    meta = ["مصحفرواية قالونعن نافعبوجه صلة ميمالجمع وتوسط المنفصلx", "صِلة", "بوجه"]
    assert one(spark, T.strip_meta, meta)[0] == "x"
    assert one(spark, T.clean_chunk, meta) == ["x", "", ""]


def test_small_functions(spark):
    assert one(spark, T.without_tags, ["<p a='1'>x</p>y"]) == ["xy"]
    assert one(spark, T.no_space, ["a  b c"]) == ["abc"]
    assert one(spark, T.padded, ["7", "1234"]) == ["007", "1234"]
    assert one(spark, T.int_or_null, ["12", "-1", "x", None]) == [12, None, None, None]
    assert one(spark, lambda c: T.on_off(c, F.lit(True)), ["0", "off", "x", None]) == [False, False, True, True]
    assert one(spark, lambda c: T.half_even(c.cast("double")), ["2.5", "3.5", "-0.5"]) == [2.0, 4.0, -0.0]
    assert one(spark, lambda c: T.distance_limit(F.length(c)), ["a", "a" * 12, "a" * 99]) == [2, 3, 6]
    assert one(spark, lambda c: T.within_distance(c, F.lit("abc"), 1), ["abd", "xyz"]) == [1, -1]


@pytest.mark.parametrize("seed", range(4))
def test_edit_scripts(seed):
    import random

    rng = random.Random(seed)
    for _ in range(200):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))
        b = "".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))
        ops = opcodes(a, b)
        cost, s, t = 0, 0, 0
        for tag, i, j, k, m in ops:
            assert (i, k) == (s, t)
            s, t = j, m
            assert (a[i:j] == b[k:m]) == (tag == "equal")
            cost += 0 if tag == "equal" else max(j - i, m - k)
        assert (s, t) == (len(a), len(b)) and cost == model.distance(a, b)


def test_edit_script_of_long_texts():
    a = "abcde" * 4000
    b = a[:7000] + "x" + a[7003:15000] + "yz" + a[15000:]
    assert sum(max(j - i, m - k) for tag, i, j, k, m in opcodes(a, b) if tag != "equal") == 5
