"""Plain models of the engine's operators, row by row, for comparison on random inputs."""

from __future__ import annotations

import unicodedata

SIGNS = set("۞۩۝ۥۦـ")


def canonical(text: str | None) -> str:
    kept = [c for c in unicodedata.normalize("NFD", text or "") if unicodedata.category(c) not in ("Mn", "Cf") and c not in SIGNS]
    return "".join({"ٱ": "ا", "ى": "ي"}.get(c, c) for c in kept)


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


def exact_owner(segments: list[str], words: list[str]) -> list[int | None]:
    """The segment of each word: segments and words are consumed in turn until a segment is spelt."""
    owner, at = [None] * len(words), 0
    for k, segment in enumerate(segments):
        if not segment:
            continue
        spelt = ""
        while at < len(words) and spelt != segment:
            spelt += words[at]
            owner[at] = k
            at += 1
    return owner


def best_cut(segments: list[str], words: list[str], limits: list[int], most: int) -> int | None:
    """The least total distance of cutting the words into runs for the segments; None if there is no way."""
    costs = {0: 0}
    for segment, limit in zip(segments, limits, strict=True):
        fresh: dict[int, int] = {}
        for start, cost in costs.items():
            for end in range(start + 1, min(len(words), start + most) + 1):
                d = distance(segment, "".join(words[start:end]))
                if d <= limit:
                    fresh[end] = min(fresh.get(end, 1 << 30), cost + d)
        costs = fresh
    return costs.get(len(words))


def overlaps(left: list[tuple[int, int]], right: list[tuple[int, int]]) -> set[tuple[int, int]]:
    return {(i, j) for i, (a, b) in enumerate(left) for j, (c, d) in enumerate(right) if min(b, d) > max(a, c)}
