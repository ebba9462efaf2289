"""What the operators of this subpackage share: durable intermediate tables, shared files and batch sizes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of an Arrow batch that is sent to a Python worker, about; a row may be larger.
BATCH_BYTES = 4 << 20

_fallback: dict[str, str] = {}
_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting (as in tests) gets a temporary folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return qualified(spark, found).rstrip("/")
    master = spark.sparkContext.master
    if master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = "file://" + tempfile.mkdtemp(prefix="quire-")
    return _fallback[app]


def qualified(spark: SparkSession, path: str) -> str:
    """A path as a URI, on the default file system if it names none: Spark and pyarrow then mean the same place."""
    if "://" in path:
        return path
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def new_path(spark: SparkSession, label: str) -> str:
    _made.append(f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:16]}")
    return _made[-1]


def clean(spark: SparkSession) -> None:
    """Removes all intermediate tables and files that this process made; results that were not written go with them."""
    while _made:
        remove(spark, _made.pop())


def write_table(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: later reads survive lost executors, and lineage ends here."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._quire_path = path
    return out


def mark() -> int:
    """Where the tables and files stand that this process has made so far, for drop_since()."""
    return len(_made)


def drop_since(spark: SparkSession, start: int, *kept: DataFrame) -> None:
    """Removes what was made since mark() gave ``start``, but for tables of write_table that later plans read."""
    keep = {df._quire_path for df in kept}
    gone = [path for path in _made[start:] if path not in keep]
    _made[start:] = [path for path in _made[start:] if path in keep]
    for path in gone:
        remove(spark, path)


def drop_table(df: DataFrame) -> None:
    """Removes a table of write_table that no later plan reads."""
    remove(df.sparkSession, df._quire_path)


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows and bytes: texts can be long, and a Python worker holds a whole batch.

    These are settings of the session that hold when a result is computed, so all operators set the same."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def tidied(run):
    """A function of batches that, at its end, gives the memory it no longer needs back: workers outlive tasks."""

    def wrapped(batches):
        yield from run(batches)
        give_back()

    return wrapped


def give_back() -> None:
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:  # another C library
        pass


def open_fs(uri: str):
    """(file system, path) for a folder or file URI; works on executors for any store that pyarrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def put_file(uri: str, write) -> None:
    """Calls write(stream) for a new file that appears under its name only when complete."""
    system, path = open_fs(uri)
    part = f"{path}.{uuid.uuid4().hex[:8]}.part"
    with system.open_output_stream(part) as out:
        write(out)
    system.move(part, path)


def make_dir(uri: str) -> str:
    system, path = open_fs(uri)
    system.create_dir(path, recursive=True)
    return uri


def text_of(column: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def id_hash_mod(column: str, n: int) -> Column:
    """crc32 of an id's decimal text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n
