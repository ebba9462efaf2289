"""Pre-tokens of a text: the matches of a tokenizer's pattern."""

from __future__ import annotations

import re
import unicodedata


def latin_class(kind: str) -> str:
    """The characters up to U+00FF of a general category, for a character class."""
    return "".join(f"\\x{i:02x}" for i in range(256) if unicodedata.category(chr(i)).startswith(kind))


class Splitter:
    """findall of a pattern with Unicode properties; texts of Latin-1 characters take the standard library's engine,
    which is more than twice as fast, by the same pattern with its properties spelled out."""

    def __init__(self, pattern: str):
        import regex

        self.slow = regex.compile(pattern).findall
        letters, numbers, spaces = latin_class("L"), latin_class("N"), r"\x09-\x0d\x20\x85\xa0"
        plain = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]")
        for name, own in ((r"\p{L}", f"[{letters}]"), (r"\p{N}", f"[{numbers}]"), (r"\S", f"[^{spaces}]"), (r"\s", f"[{spaces}]")):
            plain = plain.replace(name, own)
        self.fast = self.slow if r"\p" in plain else re.compile(plain).findall
        self.wide = re.compile(r"[^\x00-\xff]").search

    def __call__(self, text: str) -> list[str]:
        return self.fast(text) if text.isascii() or not self.wide(text) else self.slow(text)
