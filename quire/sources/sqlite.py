"""Tables of SQLite files as a Spark data source: format ``sqlite`` with options path, table and partitions.

Reading: partitions are ranges of the primary key (of the row number where a table has one) with equal numbers of rows, found
in one pass over the key's index. Columns are typed by the declared schema; columns of other declared types are read as
text. ``read`` takes the columns that are wanted, and comparisons with constants go into the file's own query where its
answer is Spark's: on columns declared INTEGER or TEXT, by the order of bytes whatever the column's collation. All others
stay with Spark.

Writing: every task writes a file of its own into a staging folder beside the target; the commit appends the files of the
tasks that count, one after the other, to a copy of the target, and puts the copy in its place. Until then the old file
stays as it is, whatever fails. Rows pass from file to file within SQLite, and their number has no limit.

Files lie on a file system that driver and executors share.
"""

from __future__ import annotations

import contextlib
import datetime
import decimal
import os
import shutil
import sqlite3
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

TYPES = {"INT": "bigint", "INTEGER": "bigint", "TEXT": "string", "REAL": "double", "BLOB": "binary"}
WRITTEN = {"boolean": "INTEGER", "tinyint": "INTEGER", "smallint": "INTEGER", "int": "INTEGER", "bigint": "INTEGER", "float": "REAL", "double": "REAL", "binary": "BLOB"}
#: Values of an IN list that go into a file's query.
MOST_VALUES = 1000
#: Rows of a batch, and of a range of the key that one task reads.
BATCH, MOST_ROWS = 20_000, 2_000_000
#: Types whose values SQLite stores as they come from Arrow.
DIRECT = {"boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "string", "binary"}


@contextlib.contextmanager
def connect(path: str) -> Iterator[sqlite3.Connection]:
    with contextlib.closing(sqlite3.connect(f"file:{path}?mode=ro", uri=True)) as con:
        yield con


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


@dataclass(frozen=True)
class Column:
    name: str
    declared: str
    key: int  # place in the primary key, from 1; 0 outside


@dataclass(frozen=True)
class Table:
    """What a file says of a table."""

    columns: tuple[Column, ...]
    row_number: str | None  # a name of the row number, if the table has one
    utf8: bool

    @classmethod
    def of(cls, path: str, name: str) -> Table:
        with connect(path) as con:
            found = con.execute("SELECT name, upper(type), pk FROM pragma_table_info(?)", (name,)).fetchall()
            kind = con.execute("SELECT type, wr FROM pragma_table_list WHERE schema = 'main' AND name = ?", (name,)).fetchone()
            utf8 = con.execute("PRAGMA encoding").fetchone()[0] == "UTF-8"
        taken = {n.lower() for n, _, _ in found}
        free = next((n for n in ("rowid", "_rowid_", "oid") if n not in taken), None)
        return cls(tuple(Column(*c) for c in found), free if kind == ("table", 0) else None, utf8)

    def key(self) -> list[str]:
        """The columns of the key by whose ranges the table is read; none for views."""
        if self.row_number:
            return [self.row_number]
        return [quoted(c.name) for c in sorted(self.columns, key=lambda c: c.key) if c.key]


COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def condition(f: Filter, table: Table, typed: dict[str, str]) -> tuple[str, list] | None:
    """A filter as SQL with its values; None if the file can't judge it as Spark does."""
    column = next((c for c in table.columns if (c.name,) == getattr(f, "attribute", None)), None)
    if column is None:
        return None
    name = quoted(column.name)
    if isinstance(f, IsNull | IsNotNull):
        return f"{name} IS {'NOT ' * isinstance(f, IsNotNull)}NULL", []
    kind = {"INTEGER": (int, ("bigint",)), "INT": (int, ("bigint",)), "TEXT": (str, ("string",))}.get(column.declared)
    values = list(f.value) if isinstance(f, In) else [getattr(f, "value", None)]
    if kind is None or typed.get(column.name) not in kind[1] or any(type(v) is not kind[0] for v in values) or len(values) > MOST_VALUES:
        return None
    own = f"{name} COLLATE BINARY" if kind[0] is str else name
    if isinstance(f, In):
        return f"{own} IN ({', '.join('?' * len(values))})", values
    # texts of other encodings are not in the order of code points
    if type(f) not in COMPARED or (kind[0] is str and type(f) is not EqualTo and not table.utf8):
        return None
    return f"{own} {COMPARED[type(f)]} ?", values


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        columns = Table.of(self.options["path"], self.options["table"]).columns
        wanted = [c for c in self.options.get("columns", "").split("\n") if c]
        return ", ".join(f"`{c.name}` {TYPES.get(c.declared, 'string')}" for c in columns if not wanted or c.name in wanted)

    def reader(self, schema) -> SqliteReader:
        return SqliteReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> SqliteWriter:
        direct = all(f.dataType.simpleString() in DIRECT for f in schema.fields)
        return (SqliteArrowWriter if direct else SqliteWriter)(self.options, schema, overwrite)


@dataclass
class KeyRange(InputPartition):
    """Rows from one key on and before another; either may be open."""

    low: tuple | None = None
    high: tuple | None = None


class SqliteReader(DataSourceReader):
    def __init__(self, options, schema):
        self.path, self.name, self.parts, self.names = options["path"], options["table"], int(options.get("partitions", 1)), schema.names
        self.table = Table.of(self.path, self.name)
        self.kinds = to_arrow_schema(schema)
        self.typed = {f.name: f.dataType.simpleString() for f in schema.fields}
        self.where: list[str] = []
        self.values: list = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            found = condition(f, self.table, self.typed)
            if found is None:
                yield f
            else:
                self.where.append(found[0])
                self.values += found[1]

    def partitions(self) -> list[InputPartition]:
        key = ", ".join(self.table.key())
        if self.parts <= 1 or not key:
            return [KeyRange()]
        with connect(self.path) as con:
            n = con.execute(f"SELECT count(*) FROM {quoted(self.name)}").fetchone()[0]
            step, cuts = max(1, -(-n // max(self.parts, -(-n // MOST_ROWS)))), []
            # from cut to cut: the file passes over the rows between without giving them
            after, values = "", []
            while len(cuts) < (n - 1) // step:
                low = con.execute(f"SELECT {key} FROM {quoted(self.name)}{after} ORDER BY {key} LIMIT 1 OFFSET {step}", values).fetchone()
                if low is None:
                    break
                cuts.append(low)
                after, values = f" WHERE ({key}) >= ({', '.join('?' * len(low))})", list(low)
        return [KeyRange(low, high) for low, high in zip([None, *cuts], [*cuts, None], strict=True)]

    def read(self, partition):
        key, where, values = self.table.key(), list(self.where), list(self.values)
        for bound, sign in ((partition.low, ">="), (partition.high, "<")):
            if bound is not None:
                where.append(f"({', '.join(key)}) {sign} ({', '.join('?' * len(key))})")
                values += bound
        declared = {c.name: c.declared for c in self.table.columns}
        what = [quoted(n) if declared.get(n) in TYPES else f"CAST({quoted(n)} AS TEXT)" for n in self.names]
        order = f" ORDER BY {', '.join(key)}" if key else ""
        with connect(self.path) as con:
            rows = con.execute(f"SELECT {', '.join(what) or '1'} FROM {quoted(self.name)}" + (f" WHERE {' AND '.join(where)}" if where else "") + order, values)
            if not what:
                yield from rows
            while what and (some := rows.fetchmany(BATCH)):
                yield pa.RecordBatch.from_arrays([as_arrow(c, f.type) for c, f in zip(zip(*some, strict=True), self.kinds, strict=True)], schema=self.kinds)


def as_arrow(values: tuple, kind: pa.DataType) -> pa.Array:
    """A column's values; SQLite holds what it was given, so that a text's column may have other values."""
    if pa.types.is_string(kind) and not all(v is None or isinstance(v, str) for v in values):
        values = tuple(v if v is None or isinstance(v, str) else str(v) for v in values)
    return pa.array(values, kind)


@dataclass
class Shard(WriterCommitMessage):
    path: str
    rows: int


def plain(value):
    """A value as SQLite stores it: dates, times and decimals as text."""
    if isinstance(value, datetime.date | datetime.datetime):
        return value.isoformat(sep=" ") if isinstance(value, datetime.datetime) else value.isoformat()
    return str(value) if isinstance(value, decimal.Decimal) else value


def filled(path: str, ddl: str, table: str, width: int, rows: Iterator) -> int:
    """Writes a file of one table from tuples; returns the number of rows."""
    n = 0

    def counted():
        nonlocal n
        for row in rows:
            n += 1
            yield row

    with contextlib.closing(sqlite3.connect(path)) as con:
        con.execute("PRAGMA journal_mode = OFF")
        con.execute("PRAGMA synchronous = OFF")
        con.execute(ddl)
        con.executemany(f"INSERT INTO {quoted(table)} VALUES ({', '.join('?' * width)})", counted())
        con.commit()
    return n


class SqliteWriter(DataSourceWriter):
    """One table. Mode ``overwrite`` replaces it, ``append`` adds to it; the file's other tables stay."""

    def __init__(self, options, schema: StructType, overwrite: bool):
        self.path, self.table, self.overwrite, self.names = options["path"], options["table"], overwrite, schema.names
        columns = ", ".join(f"{quoted(f.name)} {WRITTEN.get(f.dataType.simpleString(), 'TEXT')}" for f in schema.fields)
        self.ddl = options.get("ddl") or f"CREATE TABLE {quoted(self.table)} ({columns})"
        self.page_size = int(options.get("page_size", 4096))
        self.staging = f"{self.path}.staging-{uuid.uuid4().hex[:12]}"
        os.mkdir(self.staging)  # here alone, so that a task that outlives the job has nowhere to write

    def write(self, iterator) -> Shard:
        path = f"{self.staging}/{uuid.uuid4().hex}.sqlite"  # every attempt has its own
        return Shard(path, filled(path, self.ddl, self.table, len(self.names), self.tuples(iterator)))

    def tuples(self, rows: Iterator) -> Iterator[tuple]:
        return (tuple(map(plain, row)) for row in rows)

    def commit(self, messages: list[Shard | None]) -> None:
        made = f"{self.path}.{uuid.uuid4().hex[:12]}.part"
        try:
            if os.path.exists(self.path):
                with connect(self.path) as con:
                    con.execute("VACUUM INTO ?", (made,))
            with contextlib.closing(sqlite3.connect(made, isolation_level=None)) as con:
                con.execute(f"PRAGMA page_size = {self.page_size}")
                con.execute("PRAGMA synchronous = OFF")
                con.execute("PRAGMA journal_mode = OFF")  # what fails is thrown away whole
                if self.overwrite:
                    con.execute(f"DROP TABLE IF EXISTS {quoted(self.table)}")
                if not con.execute("SELECT 1 FROM sqlite_master WHERE type = 'table' AND name = ?", (self.table,)).fetchone():
                    con.execute(self.ddl)
                # without names the file's rows are taken over as they lie
                own = [r[0] for r in con.execute("SELECT name FROM pragma_table_info(?)", (self.table,))]
                into = "" if own == list(self.names) else f" ({', '.join(map(quoted, self.names))})"
                for shard in messages:  # in the order of the partitions
                    if shard is not None and shard.rows:
                        con.execute("ATTACH ? AS shard", (shard.path,))
                        con.execute(f"INSERT INTO main.{quoted(self.table)}{into} SELECT * FROM shard.{quoted(self.table)}")
                        con.execute("DETACH shard")
            synced(made)
            os.replace(made, self.path)
        finally:
            for left in (made, f"{made}-journal"):
                with contextlib.suppress(FileNotFoundError):
                    os.unlink(left)
            self.abort(messages)

    def abort(self, messages) -> None:
        for _ in range(5):  # a task that still runs may put a file into it meanwhile
            shutil.rmtree(self.staging, ignore_errors=True)
            if not os.path.exists(self.staging):
                return


class SqliteArrowWriter(SqliteWriter, DataSourceArrowWriter):
    """The same for columns whose values need no change: batches instead of rows."""

    def tuples(self, rows: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        return (row for batch in rows for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))


def synced(path: str) -> None:
    handle = os.open(path, os.O_RDONLY)
    try:
        os.fsync(handle)
    finally:
        os.close(handle)


def registered(spark: SparkSession) -> None:
    spark.dataSource.register(SqliteSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read(spark: SparkSession, path: str, table: str, schema: str | None = None, partitions: int = 1, columns: list[str] | None = None) -> DataFrame:
    """A table, or those of its ``columns`` that are wanted, in the order of its key."""
    registered(spark)
    reader = spark.read.format("sqlite").option("path", path).option("table", table).option("partitions", str(partitions)).option("columns", "\n".join(columns or []))
    return (reader.schema(schema) if schema else reader).load()


def write(df: DataFrame, path: str, table: str, ddl: str | None = None, keys: list[str] | None = None, mode: str = "overwrite", page_size: int = 4096) -> None:
    """Writes a table. With ``keys`` its rows are dealt to the tasks by ranges of them and written in their order, so that
    the commit only appends."""
    registered(df.sparkSession)
    rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else df
    writer = rows.write.format("sqlite").mode(mode).option("path", path).option("table", table).option("page_size", str(page_size))
    (writer.option("ddl", ddl) if ddl else writer).save()


def tables(path: str) -> list[str]:
    with connect(path) as con:
        return [r[0] for r in con.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name")]


def intact(path: str) -> bool:
    with connect(path) as con:
        return con.execute("PRAGMA integrity_check").fetchone()[0] == "ok"


# The tables, columns and keys of the mapping's relational form, and the file's page size.
DDL = {
    "metadata": "CREATE TABLE metadata (key TEXT PRIMARY KEY, value TEXT NOT NULL) WITHOUT ROWID",
    "editions": "CREATE TABLE editions (edition_id INTEGER PRIMARY KEY, edition_key TEXT NOT NULL UNIQUE, rawi TEXT NOT NULL, ayah_count INTEGER NOT NULL, reference TEXT NOT NULL) WITHOUT ROWID",
    "ayah_hafs_map": "CREATE TABLE ayah_hafs_map (edition_id INTEGER NOT NULL, surah INTEGER NOT NULL, ayah INTEGER NOT NULL, hafs_ayah INTEGER NOT NULL, PRIMARY KEY (edition_id, surah, ayah, hafs_ayah), FOREIGN KEY (edition_id) REFERENCES editions (edition_id)) WITHOUT ROWID",
}
PAGE_SIZE = 1024


def export(path: str, data: dict[str, DataFrame]) -> int:
    """Replaces the file by the tables of DDL, all at once; returns the number of their rows. A file whose keys or
    references are broken never takes the old one's place."""
    made, keys = f"{path}.{uuid.uuid4().hex[:12]}.new", {"metadata": ["key"], "editions": ["edition_id"], "ayah_hafs_map": ["edition_id", "surah", "ayah", "hafs_ayah"]}
    try:
        for name, ddl in DDL.items():
            write(data[name], made, name, ddl, keys[name], page_size=PAGE_SIZE)
        with connect(made) as con:
            broken = con.execute("PRAGMA foreign_key_check").fetchone()
            n = sum(con.execute(f"SELECT count(*) FROM {name}").fetchone()[0] for name in DDL)
        if broken:
            raise ValueError(f"a row of {broken[0]} refers to no row of {broken[2]}")
        os.replace(made, path)
    finally:
        with contextlib.suppress(FileNotFoundError):
            os.unlink(made)
    return n
