import io
import zipfile

from quire.functions import text as T
from quire.operators import rollup, styled
from quire.plans import layout
from quire.sources import docx
from quire.spec import LayoutSpec

NS = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
BREAK, LINE, PAGE = "<w:lastRenderedPageBreak/>", "<w:br/>", '<w:br w:type="page"/>'


def run(inner, size=None, bold=False, plain=False):
    props = "" if plain else f"<w:rPr>{'<w:b/>' if bold else ''}{f'<w:sz w:val=\"{size}\"/>' if size else '<w:szCs w:val=\"22\"/>'}</w:rPr>"
    return f"<w:r>{props}{inner}</w:r>"


def text(t, **kw):
    return run(f"<w:t>{t}</w:t>", **kw)


def paragraph(*runs, props=""):
    return f"<w:p>{f'<w:pPr>{props}</w:pPr>' if props else ''}{''.join(runs)}</w:p>"


def document(*paragraphs):
    section = '<w:sectPr><w:pgSz w:w="100" w:h="x"/><w:pgMar w:top="7"/><w:docGrid w:linePitch="9"/></w:sectPr>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("word/document.xml", f"<w:document {NS}><w:body>{''.join(paragraphs)}{section}</w:body></w:document>")
    return out.getvalue()


DOC = document(
    paragraph(text("preface"), run(BREAK)),  # text before the first heading: ignored, its break too
    paragraph(text(f"{T.HEADING} one"), props='<w:jc w:val="center"/><w:bidi/><w:spacing w:before="4" w:after="-2" w:lineRule="auto"/><w:widowControl w:val="0"/><w:autoSpaceDE/>'),
    paragraph(text(T.OPENING, size=30)),
    paragraph(text("a b1 "), text("c", bold=True), text("d", bold=True), text("e", plain=True), run(LINE), text("f 2"), run(PAGE), run(BREAK), text("g h"), run(LINE), text("۞"), run(LINE), text("3")),
    paragraph(text(" "), run(BREAK)),
    paragraph(run(BREAK), text(f"{T.HEADING} two")),
    paragraph(text("i j 1 k"), run(LINE), text("مصحف رواية قالون عن نافع"), run(LINE), text("l")),
)


def test_styled_layout(spark):
    docs = spark.createDataFrame([("x.docx", DOC)], "doc string, content binary")
    events, paragraphs = docx.events(docs, "Font").persist(), docx.paragraphs(docs).persist()
    parts = styled.layout(events, paragraphs)
    lines = parts["lines"].orderBy("page", "line").collect()

    def end(e):
        return (e.surah, e.ayah, e.word, e.wordIndex) if e.type == "word" else (e.surah, e.number)

    assert [(r.page, r.line, end(r.first_word), end(r.end_word), list(r.verses_on_line)) for r in lines] == [
        (1, 1, (1, 1, "a", 1), (1, 2, "cde", 1), ["1:1", "1:2"]),
        (1, 2, (1, 2, "f", 2), (1, 2), ["1:2"]),
        (2, 1, (1, 3, "g", 1), (1, 3, "h", 2), ["1:3"]),
        (2, 3, (1, 3), (1, 3), []),  # the line of a sign alone keeps its number
        (4, 1, (2, 1, "i", 1), (2, 2, "k", 1), ["2:1", "2:2"]),
        (4, 2, (2, 2, "l", 2), (2, 2, "l", 2), ["2:2"]),
    ]
    assert [(r.text, r.style.bold) for r in lines[0].runs] == [("a b1 ", False), ("cd", True), ("e", None)]
    elements = {(r.kind, r.page, r.surah, r.surahName, r.font_size_half_points) for r in parts["elements"].collect()}
    assert elements == {("heading", 1, 1, "one", 22), ("opening", 1, 1, None, 30), ("heading", 4, 2, "two", 22)}
    built = layout.build_styled(events, paragraphs, LayoutSpec(pages=4, chapters=2, layout_source="docx"), 1)
    assert built.violations.collect() == []
    assert [(r.page, len(r.lines)) for r in built.pages.orderBy("page").collect()] == [(1, 2), (2, 2), (3, 0), (4, 2)]
    assert [(r.surahId, r.startPage, r.endPage, r.ayaCount) for r in built.surahs.orderBy("surahId").collect()] == [(1, 1, 2, 3), (2, 4, 4, 2)]
    assert rollup.lines_of_chapters(built.surahs).count() == 6


def test_properties_and_geometry(spark):
    docs = spark.createDataFrame([("x.docx", DOC)], "doc string, content binary")
    props = [r.props for r in docx.paragraphs(docs).orderBy("para_no").collect()]
    p = props[1]
    assert (p.alignment, p.bidi, tuple(p.spacing), p.widow_control, p.auto_space_de, p.auto_space_dn) == ("center", True, (4, None, None, "auto", {"after": "-2"}), False, True, None)
    assert (props[0].alignment, props[0].bidi, tuple(props[0].spacing), tuple(props[0].indent)) == ("left", False, (None,) * 4 + ({},), (None,) * 4 + ({},))
    g = docx.geometries(docs).first().geometry
    assert (g.page_size_twips.width, g.page_size_twips.height, g.margins_twips.top, g.margins_twips.left, g.doc_grid.line_pitch_twips) == (100, None, 7, None, 9)


def test_one_pass_a_paragraph_at_a_time():
    """What was read is let go; elements inside tables are no paragraphs of the body."""
    import tracemalloc

    big = document(*(paragraph(text("word " * 40), text("more", bold=True)) for _ in range(6000)))
    tracemalloc.start()
    n = sum(1 for _ in docx.parts(big))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 6001 and peak < 4_000_000
    nested = document(paragraph(text("a")), f"<w:tbl>{paragraph(text('cell'))}</w:tbl>", paragraph(text("b")))
    found = list((k, "".join(x.itertext())) for k, x in docx.parts(nested))
    assert found == [(0, "a"), (1, "b"), (-1, "")]


def test_events_alone_do_not_cost_properties(spark):
    """What is not asked for is not made: no properties, no columns of them; several documents share a batch."""
    from quire.plans.catalogue import _styled_file
    from quire.sources import docx

    files = spark.createDataFrame([(str(k), bytearray(_styled_file(f"a b{k}\nc"))) for k in range(3)] + [("none", bytearray(_styled_file("")))], "doc string, content binary")
    assert docx.parsed(files, "F", "events").columns == ["doc", "para_no", "event_no", "type", "value", "style"]
    got = docx.events(files.coalesce(1), "F").collect()
    want = [("none", 0, 0, "text", "")]
    for k in "012":
        want += [(k, 0, 0, "text", "a"), (k, 0, 1, "line_break", None), (k, 0, 2, "text", f"b{k}"), (k, 1, 0, "text", "c")]
    assert sorted((r.doc, r.para_no, r.event_no, r.type, r.value) for r in got) == sorted(want)
    whole = docx.parsed(files, "F")
    assert sorted(map(str, docx.events_of(whole).collect())) == sorted(map(str, got))
    assert sorted(map(str, docx.paragraphs_of(whole).collect())) == sorted(map(str, docx.paragraphs(files).collect())) and docx.paragraphs(files).count() == 7
    assert sorted(map(str, docx.geometries_of(whole).collect())) == sorted(map(str, docx.geometries(files).collect())) and docx.geometries(files).count() == 4
