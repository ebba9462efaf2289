"""A made-up edition of three chapters on four pages, with every oddity that sources have."""

from quire.functions.text import HEADING, OPENING
from quire.spec import LayoutSpec

SPEC = LayoutSpec(pages=4, chapters=3, max_lines=5)

# (surah, ayah, text, page)
AYAT = [
    (1, 1, "alpha beta", 1), (1, 2, "gamma ۞ delta 2", 1), (1, 3, "3 epsilon zeta", 1),
    (2, 1, "eta theta iota", 2), (2, 2, "kappa lambda", 2), (2, 3, "muءnu xi omicron", 2), (2, 4, "pi rho", 3),
    (3, 1, f"{OPENING} sigma", 3), (3, 2, "tau upsilon phi", 4), (3, 3, "chi psi omega", 4),
]

# (page, text); one word is split in print, two are joined, a hamza is dropped, a marker is carried to the next line
PRINTED = [
    (1, f"{HEADING} one"), (1, OPENING), (1, "al pha beta ١ gammadelta"), (1, "٢ epsilon zeta٣"),
    (2, f"{HEADING} two"), (2, OPENING), (2, "eta theta iota1 kappa"), (2, "lambda 2 munu"), (2, "xi omicron 3"),
    (3, "pi rho 4"), (3, f"{HEADING} three"), (3, f"{OPENING} sigma 1"),
    (4, "tau upsilon"), (4, "phi 2 chi psi"), (4, "omega 3"),
]

# page, line, first word (surah, ayah, wordIndex), end: the same or (surah, verse) of a marker
LINES = [
    (1, 1, (1, 1, 1), (1, 2, 2)), (1, 2, (1, 3, 1), (1, 3)),
    (2, 1, (2, 1, 1), (2, 2, 1)), (2, 2, (2, 2, 2), (2, 3, 1)), (2, 3, (2, 3, 2), (2, 3)),
    (3, 1, (2, 4, 1), (2, 4)), (3, 2, (3, 1, 1), (3, 1)),
    (4, 1, (3, 2, 1), (3, 2, 2)), (4, 2, (3, 2, 3), (3, 3, 2)), (4, 3, (3, 3, 3), (3, 3)),
]


def ayat(spark, rows=AYAT, edition=1):
    return spark.createDataFrame([(edition, *r) for r in rows], "edition_id int, surah int, ayah int, text string, page int")


def printed(spark, rows=PRINTED, edition=1):
    out, seen = [], {}
    for page, text in rows:
        seen[page] = seen.get(page, 0) + 1
        out.append((edition, page, seen[page], text))
    return spark.createDataFrame(out, "edition_id int, page int, line_in_page int, text string")


def sources(spark, rows=PRINTED, edition=1, joined=()):
    """(formatted lines, tagged segments); the break before pages of ``joined`` is missing."""
    lines = [(edition, k, f"  {t}  ") for k, (_, t) in enumerate(rows)]
    segments: list[str] = []
    for page, text in rows:
        if len(segments) < page - sum(j <= page for j in joined):
            segments.append("")
        segments[-1] += f"<p>{text.replace(' ', '  ')}</p>\n"
    return (
        spark.createDataFrame(lines, "edition_id int, line_no bigint, text string"),
        spark.createDataFrame([(edition, k + 1, x) for k, x in enumerate(segments)], "edition_id int, segment_no int, xml string"),
    )
