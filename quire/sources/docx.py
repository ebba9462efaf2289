"""Styled documents (DOCX) as rows: paragraphs with their properties, and inline text and break events with run styles.

A file is one row of Spark's binaryFile source; its XML is parsed on the executors, once for all that is wanted and a paragraph
at a time: what has been read of the body is let go. No name of an element or attribute outside the word-processing
namespace is looked at.
"""

from __future__ import annotations

import io
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quire import schema as S

#: Fixed value: the namespace of word-processing elements.
NAMESPACE = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
OFF = ("0", "false", "off")
FLAGS = {"widow_control": "widowControl", "auto_space_de": "autoSpaceDE", "auto_space_dn": "autoSpaceDN", "adjust_right_ind": "adjustRightInd"}


#: The columns that kinds of rows need.
COLUMNS = {"events": ["doc", "para_no", "event_no", "type", "value", "style"], "paragraphs": ["doc", "para_no", "event_no", "props"], "geometries": ["doc", "para_no", "geometry"]}


def tag(name: str) -> str:
    return NAMESPACE + name


RUN, RUN_PROPERTIES, TEXT, BREAK, RENDERED = map(tag, ("r", "rPr", "t", "br", "lastRenderedPageBreak"))
SIZES, RUN_FLAGS = (tag("sz"), tag("szCs")), {"bold": tag("b"), "italic": tag("i"), "hidden": tag("vanish")}


def attribute(element: ET.Element | None, name: str) -> str | None:
    return None if element is None else element.get(tag(name))


def number(element: ET.Element | None, name: str) -> int | None:
    value = attribute(element, name)
    return int(value) if value and value.isdigit() else None


def geometry(section: ET.Element | None) -> dict | None:
    """Page size, margins and grid of the body's section; null without one."""
    if section is None:
        return None
    size, margins, grid = (section.find(tag(n)) for n in ("pgSz", "pgMar", "docGrid"))
    return {
        "page_size_twips": {n: number(size, a) for n, a in (("width", "w"), ("height", "h"))},
        "margins_twips": {n: number(margins, n) for n in ("top", "right", "bottom", "left", "header", "footer", "gutter")},
        "doc_grid": {"line_pitch_twips": number(grid, "linePitch"), "line_rule": attribute(grid, "lineRule")},
    }


def measures(element: ET.Element | None, numbers: tuple[str, ...], words: tuple[str, ...] = ()) -> dict:
    """Attributes as whole numbers, and under ``other`` those that are none, as they stand."""
    given = {n: attribute(element, n) for n in (*numbers, *words)}
    whole = {n: int(v) if n in numbers and v and v.isdigit() else v if n in words else None for n, v in given.items()}
    return whole | {"other": [(n, v) for n, v in given.items() if n in numbers and v is not None and not v.isdigit()]}


def properties(paragraph: ET.Element) -> dict:
    """Alignment, direction, spacing, indents and flags; flags are null where absent."""
    p = paragraph.find(tag("pPr"))
    found = lambda name: None if p is None else p.find(tag(name))
    out = {"alignment": attribute(found("jc"), "val") or "left", "bidi": found("bidi") is not None}
    out |= {"spacing": measures(found("spacing"), ("before", "after", "line"), ("lineRule",)), "indent": measures(found("ind"), ("left", "right", "firstLine", "hanging"))}
    for key, name in FLAGS.items():
        e = found(name)
        out[key] = None if e is None else attribute(e, "val") not in OFF
    return out


def style(run: ET.Element, font: str) -> dict:
    """The forced font, the size, and flags that are null without run properties."""
    r = run.find(RUN_PROPERTIES)
    sizes = [] if r is None else [attribute(r.find(n), "val") for n in SIZES]
    size = next((int(x) for x in sizes if x), None)
    return {"font_family": font, "font_size_half_points": size, "rtl": True} | {k: None if r is None else r.find(n) is not None for k, n in RUN_FLAGS.items()}


def inline(paragraph: ET.Element, font: str) -> Iterator[tuple[str, str | None, dict]]:
    """(type, value, style) of texts and breaks in order."""
    for run in paragraph.iter(RUN):
        own = style(run, font)
        for e in run.iter():
            if e.tag == TEXT:
                yield "text", e.text or "", own
            elif e.tag == BREAK:
                yield ("page_break" if attribute(e, "type") == "page" else "line_break"), None, own
            elif e.tag == RENDERED:
                yield "rendered_page_break", None, own


def parts(content: bytes) -> Iterator[tuple[int, ET.Element]]:
    """(number, element) of the body's own paragraphs in order, and (-1, its first section). Each element is let go when the
    next one is asked for."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive, archive.open("word/document.xml") as file:
        above: list[ET.Element] = []
        body, n, sections = None, 0, 0
        for event, element in ET.iterparse(file, ("start", "end")):
            if event == "start":
                if body is None and element.tag == tag("body"):
                    body = element
                above.append(element)
                continue
            above.pop()
            if body is None or not above or above[-1] is not body:
                if element is body:
                    return
                continue
            if element.tag == tag("p"):
                yield n, element
                n += 1
            elif element.tag == tag("sectPr") and not sections:
                yield -1, element
                sections += 1
            body.remove(element)


def files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).selectExpr("element_at(split(path, '/'), -1) AS doc", "content")


def column(values: list, kind: pa.DataType) -> pa.Array:
    """Values as Arrow; structs field by field, as rows of a struct are slow to take apart."""
    if not pa.types.is_struct(kind):
        return pa.array(values, kind)
    fields = [column([None if v is None else v[f.name] for v in values], f.type) for f in kind]
    return pa.StructArray.from_arrays(fields, fields=list(kind), mask=pa.array([v is None for v in values], pa.bool_()))


def parsed(docs: DataFrame, font: str, only: str | None = None) -> DataFrame:
    """All that ``docs`` (doc, content) hold, from one pass over each: a row for each event; one for each paragraph, with
    props and no event_no; and one for each document, with its geometry and no para_no. With ``only`` (events, paragraphs,
    geometries) what makes the other rows is not done, and their columns are not there."""
    every = StructType.fromDDL(f"{S.EVENTS}, props {S.PROPS}, geometry {S.GEOMETRY}")
    kept = [k for k, name in enumerate(every.names) if name in COLUMNS.get(only, every.names)]
    kinds = StructType([every[k] for k in kept])
    schema = to_arrow_schema(kinds)
    wanted = lambda what: only in (None, what)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([column([row[k] for row in rows], f.type) for k, f in zip(kept, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []  # of many documents, as most are short
        for given in batches:
            for doc, content in zip(*given.columns, strict=True):
                doc, section = doc.as_py(), None
                for n, element in parts(content.as_py()):
                    if n < 0:
                        section = geometry(element) if wanted("geometries") else None
                        continue
                    if wanted("paragraphs"):
                        rows.append((doc, n, None, None, None, None, properties(element), None))
                    if wanted("events"):
                        rows += [(doc, n, k, *e, None, None) for k, e in enumerate(inline(element, font))]
                    if len(rows) > 5000:
                        yield batch(rows)
                        rows = []
                if wanted("geometries"):
                    rows.append((doc, None, None, None, None, None, None, section))
        if rows:
            yield batch(rows)

    return docs.select("doc", "content").mapInArrow(run, kinds)


def events_of(rows: DataFrame) -> DataFrame:
    """doc, para_no, event_no, type, value, style of parsed documents."""
    return rows.filter("event_no IS NOT NULL").select("doc", "para_no", "event_no", "type", "value", "style")


def paragraphs_of(rows: DataFrame) -> DataFrame:
    """doc, para_no, props."""
    return rows.filter("event_no IS NULL AND para_no IS NOT NULL").select("doc", "para_no", "props")


def geometries_of(rows: DataFrame) -> DataFrame:
    """doc, geometry."""
    return rows.filter("para_no IS NULL").select("doc", "geometry")


def events(docs: DataFrame, font: str) -> DataFrame:
    return events_of(parsed(docs, font, "events"))


def paragraphs(docs: DataFrame) -> DataFrame:
    return paragraphs_of(parsed(docs, "", "paragraphs"))


def geometries(docs: DataFrame) -> DataFrame:
    return geometries_of(parsed(docs, "", "geometries"))
