import struct

import pytest

from quire.sources import legacy

SECTOR, SMALL = 512, 64


def chained(first, n):
    return [*range(first + 1, first + n), legacy.END_OF_CHAIN]


def compound(streams):
    """A compound file of the streams: those under 4,096 bytes lie in the small stream."""
    sectors, fat = [], []

    def put(data):
        n = max(1, -(-len(data) // SECTOR))
        first = len(sectors)
        sectors.extend(data[k * SECTOR : (k + 1) * SECTOR].ljust(SECTOR, b"\0") for k in range(n))
        fat.extend(chained(first, n))
        return first

    small, small_fat, placed = b"", [], {}
    for name, data in streams.items():
        if len(data) < 4096:
            n, first = -(-len(data) // SMALL), len(small_fat)
            small += data.ljust(n * SMALL, b"\0")
            small_fat += chained(first, n)
            placed[name] = first
        else:
            placed[name] = put(data)
    inner = put(small)
    table = put(b"".join(struct.pack("<I", x) for x in small_fat).ljust(SECTOR, b"\xff"))

    def entry(name, kind, start, size):
        raw = name.encode("utf-16-le")
        return raw.ljust(64, b"\0") + struct.pack("<HBB", len(raw) + 2, kind, 1) + b"\xff" * 12 + b"\0" * 36 + struct.pack("<IQ", start, size)

    directory = put(entry("Root Entry", 5, inner, len(small)) + b"".join(entry(n, 2, placed[n], len(d)) for n, d in streams.items()))
    n_fat = -(-(len(sectors) + 8) * 4 // SECTOR)
    first_fat = len(sectors)
    fat += [0xFFFFFFFD] * n_fat
    raw = b"".join(struct.pack("<I", x) for x in fat).ljust(n_fat * SECTOR, b"\xff")
    header = legacy.COMPOUND + b"\0" * 16 + struct.pack("<HHHHH", 62, 3, 0xFFFE, 9, 6) + b"\0" * 10
    header += struct.pack("<IIIIIIIII", n_fat, directory, 0, 4096, table, 1, legacy.END_OF_CHAIN, 0, 0)[: 4 * 8]
    header += struct.pack("<109I", *range(first_fat, first_fat + n_fat), *[legacy.FREE] * (109 - n_fat))
    return header + b"".join(sectors) + raw


def document(parts, flags=legacy.TABLE_FLAG, length=None, pad=0):
    """A document of pieces (text, narrow), in order; they lie in the stream in reverse."""
    main = bytearray(2048)
    ends, places = [0], []
    for text, narrow in parts:
        ends.append(ends[-1] + len(text))
    for text, narrow in reversed(parts):
        data = text.encode("cp1252" if narrow else "utf-16-le")
        places.insert(0, len(main) * 2 | 0x40000000 if narrow else len(main))
        main += data + b"\0" * (len(data) % 2)
    main += b"\0" * pad
    n = len(parts)
    plc = struct.pack(f"<{n + 1}I", *ends) + b"".join(struct.pack("<HIH", 0, p, 0) for p in places)
    clx = b"\x01" + struct.pack("<H", 5) + b"prcls" + b"\x02" + struct.pack("<I", len(plc)) + plc
    struct.pack_into("<H", main, 0, legacy.WORD)
    struct.pack_into("<H", main, 10, flags)
    struct.pack_into("<I", main, legacy.TEXT_LENGTH, ends[-1] if length is None else length)
    struct.pack_into("<II", main, legacy.PIECES_AT, 10, len(clx))
    return compound({"WordDocument": bytes(main), "1Table" if flags & legacy.TABLE_FLAG else "0Table": b"\0" * 10 + clx})


PARTS = [("Caf\xe9 “q”\r", True), ("سورة ١\rnext ", False), ("\x13 HYPERLINK x \x14shown\x15 on\x0cpage <2>\x07\x01\x08end\r", True), ("footnote", True)]


@pytest.mark.parametrize("pad", [0, 40_000])
@pytest.mark.parametrize("flags", [0, legacy.TABLE_FLAG])
def test_text_of_pieces(pad, flags):
    """Small and large streams, either table, both encodings, fields, page breaks, and text beyond the main part."""
    length = sum(len(t) for t, _ in PARTS[:3])
    text = legacy.plain(legacy.raw_text(document(PARTS, flags, length, pad)))
    assert text == "Caf\xe9 “q”\nسورة ١\nnext shown on\x0cpage <2>\nend\n"
    assert legacy.tagged(text).split("\n")[2] == "<para>next shown on<beginpage/>page &lt;2&gt;</para>"


def test_long_text_in_many_sectors():
    long = "".join(f"line {k}\r" for k in range(30_000))
    assert legacy.plain(legacy.raw_text(document([(long, True), ("é漢\r" * 9000, False)]))) == long.replace("\r", "\n") + "é漢\n" * 9000


def test_damaged_files_are_errors(spark, tmp_path):
    good = document(PARTS)
    broken = bytearray(good)
    broken[48:52] = struct.pack("<I", 3_000_000)
    locked = document(PARTS, legacy.TABLE_FLAG | legacy.ENCRYPTED_FLAG)
    for name, data in {"a.doc": good, "b.doc": b"text", "c.doc": bytes(broken), "d.doc": locked, "e.doc": good[:600], "f.doc": compound({"Other": b"x" * 5000})}.items():
        (tmp_path / name).write_bytes(data)
    rows = {r.path.rsplit("/", 1)[1]: r for r in legacy.documents(spark, str(tmp_path)).collect()}
    assert rows["a.doc"].text.startswith("Caf\xe9") and rows["a.doc"].error is None and "<beginpage/>" in rows["a.doc"].tagged
    assert all(rows[n].text is None and rows[n].error for n in ("b.doc", "c.doc", "d.doc", "e.doc", "f.doc"))
