"""WARC archives with a two-level capture index.

Every page becomes one record, a gzip member of its own. Captures are sorted by reversed-host URL key and page_id and
stored in compressed blocks of LINES lines, in one index file for each range of keys. Beside each stands its sparse
directory: an entry of ENTRY bytes for each block, and the first keys that they point to. A lookup bisects the files'
first keys, then the entries of one directory by range reads, then the lines of one block, and range-reads one record.

Of pages with equal payloads of at least ``least`` bytes the one with the smallest page_id is written as a response,
the others as revisits that name it and hold no payload.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import drop_table, make_dir, new_path, open_fs, put_file, small_batches, text_of, tidied, write_table

#: Lines in a block of the index.
LINES = 3000
#: The date of every record; pages carry none.
DATE = "1970-01-01T00:00:00Z"
#: Salts of the join that brings a payload's response to its revisits.
SALTS = 16
#: Bytes of an archive that one reading task takes.
STRETCH = 8 << 20

INDEX = "urlkey string, page_id bigint, file string, offset bigint, length bigint"


def url_key(url: str | None) -> str:
    """Reversed-host key: host labels last to first joined by commas, then ``)`` and path with query.

    Lower-case host without ``www.`` and the default port; scheme and fragment do not count; null is the empty key.
    """
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url
    host = host.removeprefix("www.")
    key = ",".join(reversed(host.split("."))) if host else ""
    if port and port not in (80, 443):
        key += f":{port}"
    return f"{key}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def header_safe(value: str) -> str:
    """Header values are one line; other characters are percent-encoded."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record, uncompressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(body)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {header_safe(url)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(headers, HTTP head, payload) of an uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(headers["Content-Length"])].partition(b"\r\n\r\n")
    return headers, http, payload


def gzip(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def gunzip(data: bytes) -> bytes:
    return zlib.decompress(data, 31)


@dataclass
class Archive:
    """An archive's folder with the table of its index files: first_key, first_page, file, blocks, lines."""

    spark: SparkSession
    folder: str
    files: DataFrame

    def index(self) -> Index:
        """The index, to be searched; the driver sees a row for each index file, at most one for each writing task."""
        rows = self.files.collect()
        return Index(sorted((sort_key(r.first_key, r.first_page), r.file, r.blocks) for r in rows))

    def lookup(self, url: str) -> Iterator[tuple[dict[str, str], bytes]]:
        """(headers, payload) of every capture of a URL, one after the other, by bisection and range reads."""
        key = url_key(url)
        for line in self.index().since((key, False, 0)):
            if line["urlkey"] != key:
                return
            system, path = open_fs(line["file"])
            with system.open_input_file(path) as file:
                headers, _, payload = parse(gunzip(file.read_at(line["length"], line["offset"])))
            yield headers, payload


def sort_key(key: str, page_id: int | None) -> tuple[str, bool, int]:
    """Lines are in this order: by key, then page_id, null first."""
    return key, page_id is not None, page_id or 0


#: An entry of a directory: offset and length of the block; offset and length of its first key in the keys; its page_id,
#: and whether it has one.
ENTRY = struct.Struct("<qqqqq?")


def write_directory(out, entries: list[tuple[int, int, str, int | None]]) -> None:
    """The entries of blocks (offset, length, first key, first page_id)."""
    at = 0
    for offset, length, key, page in entries:
        size = len(key.encode("utf-8", "surrogatepass"))
        out.write(ENTRY.pack(offset, length, at, size, page or 0, page is not None))
        at += size


class Index:
    """Searches index files with range reads; keeps the files open, and the last block."""

    def __init__(self, files: list[tuple[tuple, str, int]]):
        self.files = files
        self.open: dict[str, object] = {}
        self.block: tuple[str, int, list[dict], list[tuple]] | None = None
        self.reads = 0

    def read(self, name: str, length: int, offset: int) -> bytes:
        if name not in self.open:
            if len(self.open) > 16:
                self.open.clear()
            system, path = open_fs(name)
            self.open[name] = system.open_input_file(path)
        self.reads += 1
        return self.open[name].read_at(length, offset)

    def first_of(self, name: str, k: int) -> tuple[tuple, int, int]:
        """(first line's order, offset, length) of block k of a file."""
        offset, length, at, n, page, known = ENTRY.unpack(self.read(f"{name}.dir", ENTRY.size, k * ENTRY.size))
        return sort_key(self.read(f"{name}.keys", n, at).decode("utf-8", "surrogatepass"), page if known else None), offset, length

    def lines(self, name: str, k: int, offset: int, length: int) -> tuple[list[dict], list[tuple]]:
        if self.block is None or self.block[:2] != (name, k):
            text = gunzip(self.read(name, length, offset)).decode("utf-8", "surrogatepass")
            lines = [dict(zip(("urlkey", "page_id", "file", "offset", "length"), json.loads(x), strict=True)) for x in text.split("\n")]
            self.block = name, k, lines, [sort_key(x["urlkey"], x["page_id"]) for x in lines]
        return self.block[2:]

    def since(self, wanted: tuple) -> Iterator[dict]:
        """The lines from the first one on that is not before ``wanted``."""
        if self.block and self.block[3][0] < wanted <= self.block[3][-1]:
            f, low = next(f for f, x in enumerate(self.files) if x[1] == self.block[0]), self.block[1]
        else:
            f = max(0, bisect.bisect_left(self.files, wanted, key=lambda x: x[0]) - 1)
            # the last block that starts before, as equal lines may go back into it
            low, high = 0, self.files[f][2] if self.files else 0
            while high - low > 1:
                mid = (low + high) // 2
                low, high = (mid, high) if self.first_of(self.files[f][1], mid)[0] < wanted else (low, mid)
        for f in range(f, len(self.files)):
            _, name, blocks = self.files[f]
            for k in range(low, blocks):
                known = self.block if self.block and self.block[:2] == (name, k) else None
                lines, order = known[2:] if known else self.lines(name, k, *self.first_of(name, k)[1:])
                for at in range(bisect.bisect_left(order, wanted), len(lines)):
                    yield lines[at]
            low = 0


def revisits(pages: DataFrame, least: int) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that repeat another's payload; no payload is moved."""
    rows = pages.select("page_id", F.octet_length("html").alias("n"), F.sha2(F.col("html").cast("binary"), 256).alias("digest")).filter((F.col("n") >= least) & F.col("page_id").isNotNull()).select("page_id", "digest")
    heads = rows.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).filter("last > refers_to").select("digest", "refers_to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    return salted.join(heads, ["digest", "salt"]).filter("page_id > refers_to").select("page_id", "digest", "refers_to").distinct()


def write_archive(pages: DataFrame, least: int = 100) -> Archive:
    """Writes all rows of ``pages`` (page_id, url, html) and their index.

    A null html is the empty payload, a null url has no target header and the empty key. Rows without a page_id are
    responses. Repeated rows each get a record; rows that equal the first holder's id and payload are responses too.
    Extra columns are not read. The payloads are shuffled once, by page_id, so that a payload that fills a third of
    the table meets no single task; which pages are revisits is found on digests alone.
    """
    spark = pages.sparkSession
    small_batches(spark)
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text_of("html").alias("html"))
    folder = make_dir(new_path(spark, "warc"))
    again = revisits(given, least).withColumnsRenamed({"page_id": "of_page", "digest": "of_digest"})
    rows = given.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256)).join(again, (F.col("page_id") == F.col("of_page")) & (F.col("digest") == F.col("of_digest")), "left").select("page_id", "url", "html", "digest", "refers_to")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        lines: list[tuple] = []

        def write(out) -> None:
            at = 0
            for batch in batches:
                for page_id, url, html, digest, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    data = gzip(record(page_id, url, html.encode("utf-8", "surrogatepass"), digest, refers))
                    out.write(data)
                    lines.append((url_key(url), page_id, at, len(data)))
                    at += len(data)

        first = next(batches, None)
        if first is None:
            return
        rest = batches
        batches = (b for part in ((first,), rest) for b in part)
        put_file(name, write)
        for k in range(0, len(lines), 10_000):
            keys, ids, offsets, lengths = zip(*lines[k : k + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids, pa.int64()), pa.array([name] * len(keys)), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], names=["urlkey", "page_id", "file", "offset", "length"])

    lines = write_table(rows.mapInArrow(tidied(archive), INDEX), "captures")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{folder}/{uuid.uuid4().hex}.cdx.gz"
        entries: list[tuple[int, int, str, int | None]] = []
        n = 0

        def write(out) -> None:
            nonlocal n
            at, held = 0, []

            def block() -> None:
                nonlocal at
                data = gzip("\n".join(json.dumps(x, ensure_ascii=False) for x in held).encode("utf-8", "surrogatepass"))
                out.write(data)
                entries.append((at, len(data), *held[0][:2]))
                at += len(data)

            for batch in batches:
                for x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    held.append(x)
                    n += 1
                    if len(held) == LINES:
                        block()
                        held = []
            if held:
                block()

        first = next(batches, None)
        if first is None:
            return
        rest = batches
        batches = (b for part in ((first,), rest) for b in part)
        put_file(name, write)
        if not entries:
            return
        put_file(f"{name}.dir", lambda out: write_directory(out, entries))
        put_file(f"{name}.keys", lambda out: [out.write(x[2].encode("utf-8", "surrogatepass")) for x in entries])
        yield pa.RecordBatch.from_arrays([pa.array([entries[0][2]]), pa.array([entries[0][3]], pa.int64()), pa.array([name]), pa.array([len(entries)], pa.int64()), pa.array([n], pa.int64())], names=["first_key", "first_page", "file", "blocks", "lines"])

    placed = lines.repartitionByRange("urlkey", "page_id").sortWithinPartitions("urlkey", "page_id", "file", "offset")
    files = write_table(placed.mapInArrow(tidied(index), "first_key string, first_page bigint, file string, blocks bigint, lines bigint"), "directory")
    drop_table(lines)
    return Archive(spark, folder, files)


def found(archive: Archive, pages: DataFrame) -> DataFrame:
    """The index lines (page_id, file, offset, length) of the captures that ``pages`` (page_id, url) name, each once.

    The wanted keys are sorted in ranges, so that a task bisects once for a block and goes through its lines in order.
    """
    files = archive.index().files  # a row for each index file

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in batch.column(1).to_pylist()], pa.string()), batch.column(0)], names=["urlkey", "page_id"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(files)
        for batch in batches:
            out = []
            for key, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                wanted = sort_key(key, page)
                for x in index.since(wanted):
                    if sort_key(x["urlkey"], x["page_id"]) != wanted:
                        break
                    out.append((x["page_id"], x["file"], x["offset"], x["length"]))
            if out:
                ids, names, offsets, lengths = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(names), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], names=["page_id", "file", "offset", "length"])

    small_batches(archive.spark)
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    wanted = given.mapInArrow(tidied(keys), "urlkey string, page_id bigint").distinct()
    return wanted.repartitionByRange("urlkey", "page_id").sortWithinPartitions("urlkey", "page_id").mapInArrow(tidied(search), "page_id bigint, file string, offset bigint, length bigint")


def read_back(archive: Archive, pages: DataFrame) -> DataFrame:
    """One row per record of ``pages`` (page_id, url), looked up in the index and read by range from the archives: page_id,
    payload_bytes, payload_digest, record_type, refers_to. Length and digest of a response are taken from the payload read, and a
    digest that differs from the header's is an error; those of a revisit are its headers'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            out = []
            for page, path, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if path != name:
                    system, at = open_fs(path)
                    name, file = path, system.open_input_file(at)
                headers, http, payload = parse(gunzip(file.read_at(length, offset)))
                kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
                n = int(http.rsplit(b": ", 1)[1])
                if kind == "response":
                    n, own = len(payload), hashlib.sha256(payload).hexdigest()
                    if own != digest:
                        raise ValueError(f"the payload of page {page} is damaged")
                refers = headers.get("X-Refers-To-Page")
                out.append((page, n, digest, kind, None if refers is None else int(refers)))
            if out:
                ids, sizes, digests, kinds, refers = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests), pa.array(kinds), pa.array(refers, pa.int64())], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    stretch = F.floor(F.col("offset") / STRETCH)
    # index lines are small and what they lead to is not: their tasks must not be merged by size
    tasks = int(archive.spark.conf.get("spark.sql.shuffle.partitions"))
    placed = found(archive, pages).repartition(tasks, "file", stretch).sortWithinPartitions("file", "offset")
    return placed.select("page_id", "file", "offset", "length").mapInArrow(tidied(run), "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


#: The same for DuckDB.
WARC_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
h AS (SELECT digest, min(page_id) AS head FROM p WHERE n >= 100 AND page_id IS NOT NULL GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN n >= 100 AND page_id > head THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id > head THEN head END AS refers_to
FROM p LEFT JOIN h ON p.digest = h.digest
"""
