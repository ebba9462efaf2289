"""What distinguishes editions and builds: sizes, limits and flags, as parameters."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class LayoutSpec:
    """A printed edition's layout and how its text is aligned.

    ``opening_from`` is the first chapter whose standalone opening formula is structural; ``printed_marker`` says whether
    a marker at a line's end keeps its printed number or takes the verse of the last matched word.
    """

    pages: int = 604
    chapters: int = 114
    max_lines: int = 15
    max_words: int = 24
    max_distance: int = 6
    distance_ratio: float = 0.25
    opening_from: int = 0
    printed_marker: bool = False
    layout_source: str = "doc+sqlite"
    qiraah: str = "unknown"
    font_family: str | None = None
    schema_version: int = 3
    null_text: bool = False
    source: dict = field(default_factory=dict)

    @classmethod
    def from_config(cls, config: dict, fuzzy: bool = False) -> LayoutSpec:
        """From an edition's configuration, a JSON object; what it lacks has the defaults above."""
        align = config.get("alignment") or {}
        return cls(
            pages=int(config.get("expected_pages", 604)),
            chapters=int(config.get("expected_surahs", 114)),
            max_words=int(align.get("max_candidate_words", 24)),
            max_distance=int(align.get("max_edit_distance", 6)),
            distance_ratio=float(align.get("max_edit_distance_ratio", 0.25)),
            opening_from=2 if fuzzy else 0,
            printed_marker=fuzzy,
            null_text=fuzzy,
            layout_source=config.get("layout_source", "doc+sqlite"),
            qiraah=config.get("qiraah", "unknown"),
            font_family=config.get("font_family"),
            schema_version=int(config.get("schema_version", 3)),
        )


@dataclass(frozen=True)
class Edition:
    edition_id: int
    edition_key: str
    rawi: str
    ayah_count: int
    reference: str = "hafs-kufi"


#: The four editions and their verses.
EDITIONS = (
    Edition(1, "hafs-6236", "hafs", 6236),
    Edition(2, "warsh-6213", "warsh", 6213),
    Edition(3, "qalun-6214", "qalun", 6214),
    Edition(4, "douri-6217", "douri", 6217),
)

#: Verses whose references in the reference edition are known, as (edition, chapter, verse, references).
ANCHORS = (
    (2, 1, 1, (2,)), (3, 1, 1, (2,)), (4, 1, 1, (2,)),
    (2, 1, 6, (7,)), (2, 1, 7, (7,)), (3, 1, 6, (7,)), (3, 1, 7, (7,)), (4, 1, 6, (7,)), (4, 1, 7, (7,)),
    (2, 2, 1, (1, 2)), (3, 2, 1, (1, 2)), (4, 2, 1, (1, 2)),
    (2, 16, 123, (123, 124)), (2, 11, 82, (82, 83)), (2, 56, 52, (49, 50)),
    (4, 2, 218, (219, 220)), (4, 20, 88, (88, 89)), (4, 40, 71, (71, 72)), (4, 71, 24, (23, 24)), (4, 67, 9, (9,)),
)
