"""Legacy word-processor documents: their text from the compound file itself, without an external program.

A compound file is a file system of sectors: chains in an allocation table hold the directory and the streams, and a second
table chains the small ones inside one stream. The document's text lies in pieces of the main stream, which a table in
another stream puts in order; each piece is in one of two encodings. What is not text is left out: codes of fields (their
results stay), anchors and marks of the word processor.

A file is one row of Spark's binaryFile source; files are tasks of their own.
"""

from __future__ import annotations

import re
import struct
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession

# Signatures, special sectors, and places in the headers of the file format.
COMPOUND = bytes.fromhex("d0cf11e0a1b11ae1")
WORD = 0xA5EC
END_OF_CHAIN, FREE = 0xFFFFFFFE, 0xFFFFFFFF
TABLE_FLAG, ENCRYPTED_FLAG = 0x0200, 0x0100
TEXT_LENGTH, PIECES_AT = 0x4C, 0x1A2
#: Signs of fields: a code begins, its result begins, the field ends.
FIELD = "\x13", "\x14", "\x15"
#: Ends of paragraphs, cells and lines; page breaks; hyphens and spaces of the word processor.
SIGNS = {"\r": "\n", "\x07": "\n", "\x0b": "\n", "\x0e": "\n", "\x1e": "-", "\xa0": "\xa0"}
PAGE = "\x0c"


class Damaged(ValueError):
    """A file that is not what its headers say."""


class Compound:
    """The streams of a compound file by name."""

    def __init__(self, data: bytes):
        if data[:8] != COMPOUND:
            raise Damaged("no compound file")
        self.data = data
        self.size = 1 << struct.unpack_from("<H", data, 30)[0]
        self.small = 1 << struct.unpack_from("<H", data, 32)[0]
        first_directory = struct.unpack_from("<I", data, 48)[0]
        self.least, first_small, _, more, _ = struct.unpack_from("<5I", data, 56)
        tables = [s for s in struct.unpack_from("<109I", data, 76) if s < END_OF_CHAIN]
        seen = set()
        while more < END_OF_CHAIN:
            if more in seen:
                raise Damaged("a chain of sectors has a loop")
            seen.add(more)
            *found, more = struct.unpack(f"<{self.size // 4}I", self.sector(more))
            tables += [s for s in found if s < END_OF_CHAIN]
        self.next = [n for t in tables for n in struct.unpack(f"<{self.size // 4}I", self.sector(t))]
        chain = self.chain(first_small) if first_small < END_OF_CHAIN else b""
        self.next_small = list(struct.unpack(f"<{len(chain) // 4}I", chain))
        self.entries = {}
        directory = self.chain(first_directory)
        for at in range(0, len(directory), 128):
            length, kind = struct.unpack_from("<HB", directory, at + 64)
            start, size = struct.unpack_from("<IQ", directory, at + 116)
            name = directory[at : at + max(0, length - 2)].decode("utf-16-le", "replace")
            if kind in (2, 5):
                self.entries.setdefault("" if kind == 5 else name, (start, size))
        self.inner = self.chain(self.entries[""][0]) if self.entries.get("", (FREE,))[0] < END_OF_CHAIN else b""

    def sector(self, n: int) -> bytes:
        out = self.data[(n + 1) * self.size : (n + 2) * self.size]
        if not out:
            raise Damaged(f"sector {n} is not there")
        return out.ljust(self.size, b"\0")

    def chain(self, n: int) -> bytes:
        return self.joined(n, self.next, self.sector)

    def joined(self, n: int, following: list[int], sector) -> bytes:
        out = []
        while n != END_OF_CHAIN:
            if n >= len(following) or len(out) > len(following):
                raise Damaged("a chain of sectors has a loop or no end")
            out.append(sector(n))
            n = following[n]
        return b"".join(out)

    def stream(self, name: str) -> bytes:
        if name not in self.entries:
            raise Damaged(f"no stream {name}")
        start, size = self.entries[name]
        if not size:
            return b""
        if size < self.least:
            return self.joined(start, self.next_small, lambda n: self.inner[n * self.small : (n + 1) * self.small])[:size]
        return self.chain(start)[:size]


def pieces(main: bytes, table: bytes) -> list[tuple[int, int, int, bool]]:
    """(first character, end, place in the main stream, whether in one byte a character) of the text's pieces."""
    at, length = struct.unpack_from("<II", main, PIECES_AT)
    block, k = table[at : at + length], 0
    while k < len(block) and block[k] == 1:  # formats of the pieces
        k += 3 + struct.unpack_from("<H", block, k + 1)[0]
    if k >= len(block) or block[k] != 2:
        raise Damaged("no table of pieces")
    size = struct.unpack_from("<I", block, k + 1)[0]
    n, first = (size - 4) // 12, k + 5
    ends = struct.unpack_from(f"<{n + 1}I", block, first)
    out = []
    for i in range(n):
        place = struct.unpack_from("<I", block, first + 4 * (n + 1) + 8 * i + 2)[0]
        narrow = bool(place & 0x40000000)
        place &= 0x3FFFFFFF
        out.append((ends[i], ends[i + 1], place // 2 if narrow else place, narrow))
    return out


def raw_text(content: bytes) -> str:
    """The main text with the word processor's signs in it."""
    file = Compound(content)
    main = file.stream("WordDocument")
    kind, flags = struct.unpack_from("<H", main)[0], struct.unpack_from("<H", main, 10)[0]
    if kind != WORD:
        raise Damaged("no document of this word processor")
    if flags & ENCRYPTED_FLAG:
        raise Damaged("the document is encrypted")
    table = file.stream("1Table" if flags & TABLE_FLAG else "0Table")
    length, out = struct.unpack_from("<I", main, TEXT_LENGTH)[0], []
    for low, high, place, narrow in pieces(main, table):
        n = min(high, length) - low
        if n > 0:
            out.append(main[place : place + n].decode("cp1252", "replace") if narrow else main[place : place + 2 * n].decode("utf-16-le", "replace"))
    return "".join(out)


def plain(raw: str) -> str:
    """Text with paragraphs as lines and page breaks as form feeds; of fields the results alone."""
    out, fields = [], []
    for part in re.split(f"([{''.join(FIELD)}])", raw):
        if part == FIELD[0]:
            fields.append(True)
        elif part == FIELD[1]:
            fields[-1:] = [False] if fields else []
        elif part == FIELD[2]:
            fields[-1:] = []
        elif not any(fields):
            out.append(part)
    text = "".join(out).translate(str.maketrans(SIGNS))
    return re.sub(r"[\x00-\x08\x0f-\x1f]", "", text)


def tagged(text: str, tag: str = "<beginpage/>") -> str:
    """Paragraphs as elements, page breaks as tags between them or inside."""
    return "\n".join(f"<para>{tag.join(escape(part) for part in line.split(PAGE))}</para>" for line in text.split("\n"))


def documents(spark: SparkSession, path: str) -> DataFrame:
    """path, text (lines; page breaks as form feeds), tagged (elements with page tags) and error of legacy documents. A file
    that can't be read has an error and no text."""

    def run(batches):
        for pdf in batches:
            rows = []
            for name, content in zip(pdf.path, pdf.content, strict=True):
                try:
                    text = plain(raw_text(content))
                    rows.append((name, text, tagged(text), None))
                except (Damaged, struct.error) as error:
                    rows.append((name, None, None, str(error)))
            yield pdf[["path"]].assign(text=[r[1] for r in rows], tagged=[r[2] for r in rows], error=[r[3] for r in rows])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, text string, tagged string, error string")
