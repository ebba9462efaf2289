"""Text functions as column expressions: normal forms of Arabic script, digits, tokens, tags.

Every function takes and gives columns, stays in generated code and treats null as its docstring says. The normal forms
differ on purpose (what becomes of a hamza, of spaces, of the letters that carry a hamza), so none is built on another.
Canonical decomposition and, for editions, compatibility composition are part of them: their tables are built from the
Unicode data of the standard library, as far as marks are dropped anyway. Hangul syllables stay composed.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters, marks and phrases that the results depend on.
HEADING = "سُورَةُ"
OPENING = "بسم الله الرحمن الرحيم"
RUB = "۞"
TATWEEL = "ـ"
DIGITS_FROM = "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹"
DIGITS_TO = "01234567890123456789"
DIGIT_CLASS = "[٠-٩۰-۹0-9]"
META_PHRASES = (("مصحف", "رواية", "قالون", "عن", "نافع"), ("بوجه", "صلة", "ميم", "الجمع", "وتوسط", "المنفصل"))
META_CHUNKS = ("مصحف رواية قالون عن نافع", "بوجه", "صلة", "ميم الجمع وتوسط المنفصل")
# letters of editions and the basic ones that they are folded to
FOLDED = ("ٱأإآٲٳٵىئؤءٶٸ", "اااااااييواوي")


def _unmarked() -> dict[str, str]:
    """What canonical decomposition makes of composed characters, marks aside; those of Hangul are left out."""
    out = {}
    for c in map(chr, [*range(0xA0, 0xAC00), *range(0xF900, 0xFFFE)]):
        plain = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if plain not in ("", c):
            out[c] = plain
    return out


def _folded_letters() -> dict[str, str]:
    """Presentation forms and other compatibility characters as the basic Arabic letters that they stand for."""
    out = {}
    for c in map(chr, [*range(0x0600, 0x0900), *range(0xFB50, 0xFE00), *range(0xFE70, 0xFF00)]):
        whole = unicodedata.normalize("NFKC", c)
        if whole != c and any("\u0621" <= x <= "\u064a" or x in FOLDED[0] for x in whole):
            out[c] = whole
    return out


_ONE = {c: x for c, x in _unmarked().items() if len(x) == 1}
COMPOSED = ("".join(_ONE), "".join(_ONE.values()))
FORMS = _folded_letters()

#: Marks, format characters, tatweel and annotation signs; the ranges are marks that older Unicode tables do not know.
#: The range in front rules out most letters by one comparison, as every part of a class is tried for every character.
DROPPED = rf"[\xAD\u0300-\x{{10FFFF}}&&[\p{{Mn}}\p{{Cf}}{TATWEEL}\u06DD\u06DE\u06E5\u06E6\u06E9\u0898-\u089F\u08CA-\u08D2]]"
MARKS = rf"[\u0300-\x{{10FFFF}}&&[\p{{Mn}}\u0898-\u089F\u08CA-\u08D2]]"
#: White space of all of Unicode, with the separators that count as white space in text processing. Single
#: characters of Latin-1 are one table in Java's classes, ranges are not.
_LATIN = r"\t\n\x0B\f\r\x1C\x1D\x1E\x1F \x85\xA0"
_WIDE = r"\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
SPACE = rf"[{_LATIN}[\u1680-\u3000&&[{_WIDE}]]]"


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def strip(c: Column) -> Column:
    """Without white space of any kind at the ends; null stays null."""
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", "")


def has_text(c: Column) -> Column:
    """Whether anything but white space is there; null stays null. Found at the first such character."""
    return c.rlike(rf"[^{_LATIN}{_WIDE}]")


def canonical(c: Column) -> Column:
    """Letters only, for exact matching: marks, format characters, tatweel and signs go, letters that carry a hamza or
    madda become their base, spaces stay. Null is the empty text. ASCII has none of these and stays as it is."""
    text = _text(c)
    return F.when(_ascii(text), text).otherwise(F.regexp_replace(F.translate(text, COMPOSED[0] + "ٱى", COMPOSED[1] + "اي"), DROPPED, ""))


def canonical_loose(c: Column) -> Column:
    """canonical without the lone hamza."""
    return F.when(_ascii(_text(c)), _text(c)).otherwise(F.translate(canonical(c), "ء", ""))


def fuzzy_canonical(c: Column) -> Column:
    """For distances: carried hamzas of waw and ya become lone ones and the small alef a letter before all else, then
    as canonical, and spaces go."""
    return F.translate(canonical(F.translate(_text(c), "ئؤ\u0670", "ءءا")), " ", "")


def compatible(c: Column) -> Column:
    """Presentation forms as the letters that they stand for; texts without any are left as they are."""
    table = F.str_to_map(F.lit("\n".join(f"{c}\t{x}" for c, x in FORMS.items())), F.lit("\n"), F.lit("\t"))  # a constant
    forms = "[" + "".join(FORMS) + "]"
    letters = F.transform(F.split(c, ""), lambda x: F.when(x.rlike(forms), F.element_at(table, x)).otherwise(x))
    return F.when(c.rlike(forms), F.array_join(letters, "")).otherwise(c)


def mapping_normal(c: Column) -> Column:
    """For alignment of editions: folded letters, nothing but basic letters stays, the lone hamza is an alef."""
    folded = F.translate(compatible(_text(c)), *FOLDED)
    return F.regexp_replace(folded, r"[^\u0621-\u063A\u0641-\u064A]", "")


def structural(c: Column) -> Column:
    """For headings and formulas of a styled document: marks and tatweel go, white space is one space."""
    plain = F.regexp_replace(F.translate(_text(c), COMPOSED[0] + "ٱ\u00a0", COMPOSED[1] + "ا "), rf"{MARKS}|{TATWEEL}", "")
    return F.regexp_replace(F.regexp_replace(plain, rf"{SPACE}+", " "), "^ | $", "")


def digits_to_int(c: Column) -> Column:
    """Eastern or ASCII digits as a number; null for anything else."""
    return F.when(is_digits(c), F.translate(c, DIGITS_FROM, DIGITS_TO).try_cast("int"))


def is_digits(c: Column) -> Column:
    return c.rlike(rf"\A{DIGIT_CLASS}+\z")


def strip_meta(c: Column) -> Column:
    """Without the metadata phrases, whatever the spaces in them."""
    out = _text(c)
    for phrase in META_PHRASES:
        out = F.regexp_replace(out, rf"{SPACE}*".join(phrase), "")
    return out


def clean_chunk(c: Column) -> Column:
    """strip_meta, and nothing if only a part of a metadata phrase is left."""
    value = strip_meta(c)
    return F.when(structural(value).isin(*META_CHUNKS), F.lit("")).otherwise(value)


def is_heading(c: Column) -> Column:
    """A chapter heading; a verse that starts with the same word in another case ending is none."""
    return F.coalesce(c.rlike(rf"\A{SPACE}*{HEADING}{SPACE}+\S"), F.lit(False))


def heading_name(c: Column) -> Column:
    """The chapter's name in a heading, else null."""
    return F.when(is_heading(c), strip(F.regexp_extract(strip(c), rf"(?s)\A{HEADING}{SPACE}+(.+)\z", 1)))


def is_styled_heading(c: Column) -> Column:
    """In a styled document the prefix is enough."""
    return strip(strip_meta(c)).startswith(HEADING)


def styled_heading_name(c: Column) -> Column:
    return F.regexp_replace(strip(strip_meta(c)), rf"\A{HEADING}{SPACE}*", "")


def is_opening(c: Column) -> Column:
    """A line that is the opening formula and nothing else."""
    return strip(canonical(c)) == F.lit(OPENING)


def starts_with_opening(c: Column) -> Column:
    """In a styled document: starts with the formula."""
    return structural(strip_meta(c)).startswith(OPENING)


def is_numbered_opening(text: Column, marker: Column) -> Column:
    """The formula as a numbered first verse."""
    return (marker == 1) & (strip(canonical(text)) == F.lit(OPENING))


def without_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", "")


def no_space(c: Column) -> Column:
    """Without white space of any kind."""
    return F.regexp_replace(c, SPACE, "")


def tokens(c: Column) -> Column:
    """Split at white space of any kind; no empty tokens. Null gives an empty array."""
    return F.filter(F.split(_text(c), rf"{SPACE}+"), lambda t: t != "")


def _part(token: Column, marker: Column) -> Column:
    return F.struct(token.alias("token"), marker.try_cast("int").alias("marker"))


def split_token(c: Column, leading: bool = True) -> Column:
    """array<struct<token, marker>> of a token: words and verse numbers that it holds.

    Digits alone are a number. Digits in front are a number and a word (unless ``leading`` is off), digits behind a
    word and a number; front is tried first. A number too large for an int is null. The section sign goes; nothing left
    gives an empty array.
    """
    t = F.translate(strip(_text(c)), RUB, "")
    head, tail = rf"(?s)\A({DIGIT_CLASS}+)(.+)\z", rf"(?s)\A(.+?)({DIGIT_CLASS}+)\z"
    number = lambda x: F.translate(x, DIGITS_FROM, DIGITS_TO)
    none, no_text = F.lit(None).cast("int"), F.lit("")
    out = F.when(t == "", F.array().cast("array<struct<token:string,marker:int>>")).when(~t.rlike(DIGIT_CLASS), F.array(_part(t, none)))
    out = out.when(is_digits(t), F.array(_part(no_text, number(t))))
    if leading:
        out = out.when(t.rlike(head), F.array(_part(no_text, number(F.regexp_extract(t, head, 1))), _part(F.regexp_extract(t, head, 2), none)))
    out = out.when(t.rlike(tail), F.array(_part(F.regexp_extract(t, tail, 1), none), _part(no_text, number(F.regexp_extract(t, tail, 2)))))
    return out.otherwise(F.array(_part(t, none)))


def split_line(c: Column, leading: bool = True) -> Column:
    """All parts of a line's tokens, in order. In a line without digits and section signs the tokens are the parts."""
    whole = F.transform(tokens(c), lambda t: _part(t, F.lit(None).cast("int")))
    return F.when(c.rlike(f"{DIGIT_CLASS}|{RUB}"), F.flatten(F.transform(tokens(c), lambda t: split_token(t, leading)))).otherwise(whole)


def key(*columns: Column | str) -> Column:
    """Composite keys as text."""
    return F.concat_ws(":", *columns)


def padded(c: Column, width: int = 3) -> Column:
    """Zero-padded to a width, never cut."""
    text = c.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def half_even(c: Column) -> Column:
    """Rounded, halves to even."""
    return F.bround(c)


def at_least_one(c: Column) -> Column:
    return F.greatest(F.lit(1), c)


def int_or_null(c: Column) -> Column:
    """An attribute as a number if it is digits only."""
    return F.when(c.rlike(r"\A[0-9]+\z"), c.try_cast("int"))


def on_off(c: Column, present: Column) -> Column:
    """A tri-state flag: null if absent, true without a value, else false for 0, false and off."""
    return F.when(present, F.when(c.isNull(), True).otherwise(~c.isin("0", "false", "off")))


def sha256(c: Column) -> Column:
    """Hex digest of a text's or file's bytes."""
    return F.sha2(c.cast("binary"), 256)


def distance_limit(length: Column, most: int = 6, ratio: float = 0.25) -> Column:
    """The distance that a segment of so many characters may have: 2 at least, a share of the length, ``most``."""
    share = F.greatest(F.lit(2), (length * ratio).cast("int"))
    return F.greatest(F.lit(2), F.least(F.lit(most), share))


def within_distance(a: Column, b: Column, limit: int | None = None) -> Column:
    """Edit distance by code points; -1 beyond ``limit``."""
    return F.levenshtein(a, b) if limit is None else F.levenshtein(a, b, limit)
