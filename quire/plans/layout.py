"""Layout builds from sources to records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators import align_exact, align_fuzzy, checks, lines, pages, rollup, styled, words
from quire.spec import LayoutSpec


@dataclass
class Layout:
    """A build's results; ``violations`` is empty if it may be used."""

    lines: DataFrame
    pages: DataFrame
    surahs: DataFrame
    violations: DataFrame
    path: DataFrame | None = None
    held: tuple[DataFrame, ...] = ()

    def release(self) -> None:
        """Frees what the build holds; call it once the results are written."""
        for df in self.held:
            df.unpersist()


def build(printed: DataFrame, ayat: DataFrame, spec: LayoutSpec, fuzzy: bool = False) -> Layout:
    """From printed lines (edition_id, page, line_in_page, text) and verses (edition_id, surah, ayah, text, page).

    The word stream, the classified lines, the segments and the aligned lines are used several times and held in memory
    or on disk until ``release``.
    """
    stream = words.words(ayat).persist()
    classified = lines.classified(printed, spec).persist()
    text = lines.numbered(classified).filter("surah > 0")
    segs, ends = (df.persist() for df in lines.segments(text))
    path = None
    if fuzzy:
        own, bad, path = align_fuzzy.align(segs, ends, stream, spec)
    else:
        own, bad = align_exact.align(segs, ends, stream, spec)
    own = own.persist()
    on_page = lines.page_chapters(classified)
    records = rollup.page_records(own, on_page, spec)
    surahs = rollup.chapter_records(own, lines.chapters(classified), spec)
    count = checks.record_count(records, spec.pages, "page")
    size = checks.violation(records.filter((F.size("lines") < 1) | (F.size("lines") > spec.max_lines)), "page_lines", F.concat_ws(":", "edition_id", "page"), F.size("lines"))
    found = checks.union([bad, lines.line_violations(classified, spec), checks.source_verses(ayat, spec), count, size])
    return Layout(own, records, surahs, found, path, (stream, classified, segs, ends, own))


def build_from_document(printed_lines: DataFrame, segments: DataFrame, ayat: DataFrame, spec: LayoutSpec, fuzzy: bool = False) -> Layout:
    """From formatted lines and tagged page segments of a converted document."""
    printed, bad = pages.printed_pages(printed_lines, segments, spec)
    out = build(printed, ayat, spec, fuzzy)
    out.violations = out.violations.unionByName(bad)
    out.held += printed.held
    return out


def build_styled(events: DataFrame, paragraphs: DataFrame, spec: LayoutSpec, edition_id: int) -> Layout:
    """From a styled document's events and paragraphs; pages without lines are there and empty."""
    parts = styled.layout(events, paragraphs)
    tagged = {k: df.withColumn("edition_id", F.lit(edition_id)) for k, df in parts.items()}
    records = rollup.page_records(tagged["lines"], tagged["page_chapters"], spec)
    surahs = rollup.chapter_records(tagged["lines"], tagged["chapters"], spec, own_markers_only=True)
    size = checks.violation(records.filter(F.size("lines") > spec.max_lines), "page_lines", F.concat_ws(":", "edition_id", "page"), F.size("lines"))
    found = checks.union([size, checks.record_count(records, spec.pages, "page"), checks.record_count(surahs, spec.chapters, "chapter")])
    return Layout(tagged["lines"], records, surahs, found)


def manifest(spec: LayoutSpec, source: dict) -> dict:
    """The manifest of a layout, as written beside its records."""
    return {"schema_version": spec.schema_version, "layout_source": spec.layout_source, "qiraah": spec.qiraah, "font_family": spec.font_family, "source": source, "total_pages": spec.pages, "total_surahs": spec.chapters}


def styled_manifest(spec: LayoutSpec, geometry: dict | None, pages: int, chapters: int) -> dict:
    """The manifest of a styled document's layout: its one font, for which all others were left out, and its geometry."""
    policy = {"mode": "forced_single_mushaf_font", "forced_font_family": spec.font_family, "other_docx_font_families_ignored": True}
    return {"schema_version": spec.schema_version, "layout_source": "docx", "font_family": spec.font_family, "font_policy": policy, "document_page_geometry": geometry or {}, "total_pages": pages, "total_surahs": chapters}
