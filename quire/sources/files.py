"""Text, tagged text, JSON records and digests of files, and their sinks."""

from __future__ import annotations

import json
import os
import subprocess
import tempfile
import uuid
from collections import Counter
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from quire import schema as S
from quire.functions import text as T
from quire.operators.streams import prefix_sum


#: Ends of lines beside those that Spark's reader knows.
OTHER_ENDS = r"[\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def stretches(spark: SparkSession, path: str) -> DataFrame:
    """part, at, value: the lines of text files, read by as many tasks as the files have splits. The order within a file is
    that of ``part`` (file and split) and of ``at`` within it."""
    lines = spark.read.text(path)
    return lines.select(F.struct("_metadata.file_path", "_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("at"), "value")


def printed_lines(spark: SparkSession, path: str, edition_id: int) -> DataFrame:
    """Lines of formatted text files with their numbers, from 0; several files follow each other by name."""
    pieces = stretches(spark, path).withColumn("pieces", F.split("value", OTHER_ENDS)).withColumn("edition_id", F.lit(edition_id))
    counted = prefix_sum(pieces, F.size("pieces"), ["edition_id"], "part", ["at"], "before")
    return counted.select("edition_id", "before", F.posexplode("pieces").alias("k", "text")).select("edition_id", (F.col("before") + F.col("k")).alias("line_no"), "text")


def page_segments(spark: SparkSession, path: str, edition_id: int, tag: str = "<beginpage/>") -> DataFrame:
    """Segments of tagged text files between page tags, from 1. A line with tags ends one segment and begins others; the lines
    of a segment are joined again."""
    pieces = stretches(spark, path).withColumn("pieces", F.split("value", "\\Q" + tag + "\\E")).withColumn("edition_id", F.lit(edition_id))
    counted = prefix_sum(pieces, F.size("pieces") - 1, ["edition_id"], "part", ["at"], "before")
    rows = counted.select("edition_id", "part", "at", "before", F.posexplode("pieces").alias("k", "text"))
    segment = (F.col("before") + F.col("k") + 1).cast("int").alias("segment_no")
    held = F.array_sort(F.collect_list(F.struct("part", "at", "text")))  # a page's lines
    return rows.groupBy("edition_id", segment).agg(F.array_join(F.transform(held, lambda x: x["text"]), "\n").alias("xml"))


#: What the external converter is called with, by mode.
MODES = {"text": ("-f", "-m", "UTF-8.txt"), "xml": ("-x", "db")}


def converted(spark: SparkSession, path: str, mode: str, program: str = "antiword") -> DataFrame:
    """(path, value) of legacy word-processor files, run through an external converter on the executors."""
    if mode not in MODES:
        raise ValueError(f"no mode {mode!r}: {', '.join(MODES)}")
    arguments = MODES[mode]

    def run(batches):
        for pdf in batches:
            out = []
            for content in pdf.content:
                with tempfile.NamedTemporaryFile(suffix=".doc") as file:
                    file.write(content)
                    file.flush()
                    try:
                        done = subprocess.run([program, *arguments, file.name], check=True, capture_output=True)
                    except FileNotFoundError as error:
                        raise RuntimeError(f"{program} is not installed") from error
                    except subprocess.CalledProcessError as error:
                        raise RuntimeError(f"{program} failed: {error.stderr.decode(errors='replace').strip()}") from error
                out.append(done.stdout.decode("utf-8", "replace"))
            yield pdf[["path"]].assign(value=out)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, value string")


def digests(spark: SparkSession, *paths: str) -> DataFrame:
    """(name, sha256, bytes) of files."""
    files = spark.read.format("binaryFile").load(list(paths))
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), T.sha256(F.col("content")).alias("sha256"), F.col("length").alias("bytes"))


def config(path: str) -> dict:
    """Control data, read on the driver."""
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def pages(spark: SparkSession, folder: str, edition_id: int) -> DataFrame:
    """Page records, one file each, with the file's name."""
    return spark.read.schema(S.PAGE).json(folder, multiLine=True).select(F.lit(edition_id).alias("edition_id"), "*", F.col("_metadata.file_name").alias("file_name"))


def surahs(spark: SparkSession, folder: str, edition_id: int) -> DataFrame:
    return spark.read.schema(S.SURAH).json(folder, multiLine=True).select(F.lit(edition_id).alias("edition_id"), "*", F.col("_metadata.file_name").alias("file_name"))


def manifests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("schema_version int, layout_source string, qiraah string, font_family string, source map<string,string>, total_pages int, total_surahs int").json(path, multiLine=True)


def counts(spark: SparkSession, path: str) -> DataFrame:
    """(system, total, surah, n) of a table of verse counts."""
    raw = spark.read.schema(S.COUNTS).json(path, multiLine=True)
    return raw.select(F.col("_counting_system").alias("system"), F.col("_total_ayahs").alias("total"), F.explode("surahs").alias("surah", "n")).withColumn("surah", F.col("surah").cast("int"))


def rawis(spark: SparkSession, path: str) -> DataFrame:
    """Descriptors of readings: their flat fields and deprecated ones as maps."""
    text = spark.read.text(path, wholetext=True)
    flat = F.from_json("value", "map<string,string>")
    return text.select(F.map_filter(flat, lambda k, v: k != "_deprecated").alias("fields"), F.from_json(F.get_json_object("value", "$._deprecated"), "map<string,string>").alias("deprecated"))


def without_nulls(value):
    """Ends of lines drop fields that they do not have; everything else keeps its nulls."""
    if isinstance(value, dict):
        kept = {k: without_nulls(v) for k, v in value.items()}
        return {k: v for k, v in kept.items() if v is not None} if "type" in value else kept
    return [without_nulls(v) for v in value] if isinstance(value, list) else value


def rendered(value) -> str:
    return json.dumps(value, ensure_ascii=False, indent=2) + "\n"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``, which driver and executors share; a local session without that
    setting (as in tests) gets a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="quire-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def file_system(path: str) -> tuple:
    """(file system, path) of a path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else f"file://{os.path.abspath(path)}")


def exists(system, path: str) -> bool:
    return bool(system.get_file_info(path).type)


@dataclass
class Written(WriterCommitMessage):
    folder: str
    names: list[str]


class RecordSink(DataSource):
    """Rows (name, json) as a file each in the folder ``path``, which must not be there yet."""

    @classmethod
    def name(cls) -> str:
        return "records"

    def writer(self, schema, overwrite: bool) -> RecordWriter:
        return RecordWriter(self.options["path"])


class RecordWriter(DataSourceWriter):
    """Tasks write into folders of their own attempt. The commit gathers the files of the attempts that count under the
    folder's name, as the last step; without a commit there is no folder."""

    def __init__(self, path: str):
        self.path, self.staging = path, f"{path}.staging-{uuid.uuid4().hex[:12]}"

    def write(self, iterator) -> Written:
        system, staging = file_system(self.staging)
        folder, names = f"{staging}/{uuid.uuid4().hex}", []
        for name, text in iterator:
            if not names:
                system.create_dir(folder, recursive=True)
            with system.open_output_stream(f"{folder}/{name}") as out:
                out.write(rendered(without_nulls(json.loads(text))).encode())
            names.append(name)
        return Written(folder, names)

    def commit(self, messages: list[Written | None]) -> None:
        system, path = file_system(self.path)
        staging = file_system(self.staging)[1]
        found = [(m.folder, n) for m in messages if m for n in m.names]
        twice = [n for n, times in Counter(n for _, n in found).items() if times > 1]
        if twice:
            raise ValueError(f"several records are named {twice[0]}")
        whole = f"{staging}/all"
        system.create_dir(whole, recursive=True)
        with ThreadPoolExecutor(16) as pool:  # a rename each, within one file system
            list(pool.map(lambda m: system.move(f"{m[0]}/{m[1]}", f"{whole}/{m[1]}"), found))
        system.move(whole, path)
        self.abort(messages)

    def abort(self, messages) -> None:
        system, staging = file_system(self.staging)
        if exists(system, staging):
            system.delete_dir(staging)


def export_records(df: DataFrame, folder: str, name: F.Column, **totals: F.Column) -> dict:
    """Writes each row as a JSON file, named by ``name``, into a new folder. Returns the number of ``records`` and the
    ``totals`` (aggregates over the rows), which come from the same pass."""
    df.sparkSession.dataSource.register(RecordSink)
    seen = Observation()
    aggregates = [F.count(F.lit(1)).alias("records"), *(c.alias(n) for n, c in totals.items())]
    rows = df.observe(seen, *aggregates).select(name.alias("name"), F.to_json(F.struct(*[c for c in df.columns if c != "edition_id"]), {"ignoreNullFields": "false"}).alias("json"))
    rows.write.format("records").mode("append").option("path", folder).save()
    return dict(seen.get)


def export_layout(pages: DataFrame, surahs: DataFrame, manifest: dict, folder: str) -> dict:
    """pages/page_001.json .., surahs/001.json .. and, last of all, manifest.json of one edition, in the place of what was in
    the folder. All is written beside it first: whoever reads the folder sees the old set or the new one. Returns the totals:
    pages, lines, and surahs."""
    mark = uuid.uuid4().hex[:12]
    made, old = f"{folder}.new-{mark}", f"{folder}.old-{mark}"
    system, path = file_system(folder)
    try:
        on_pages = export_records(pages, f"{made}/pages", F.concat(F.lit("page_"), T.padded(F.col("page")), F.lit(".json")), lines=F.coalesce(F.sum(F.size("lines")), F.lit(0)))
        of_surahs = export_records(surahs, f"{made}/surahs", F.concat(T.padded(F.col("surahId")), F.lit(".json")))
        with system.open_output_stream(f"{file_system(made)[1]}/manifest.json") as out:
            out.write(rendered(manifest).encode())
        if exists(system, path):
            system.move(path, file_system(old)[1])
        system.move(file_system(made)[1], path)
    finally:
        for left in (made, old):
            left = file_system(left)[1]
            if exists(system, left):
                # a set that was moved away comes back if the new one could not take its place
                if exists(system, path):
                    system.delete_dir(left)
                elif ".old-" in left:
                    system.move(left, path)
    return {"pages": on_pages["records"], "lines": on_pages["lines"], "surahs": of_surahs["records"]}


def write_relations(folder: str, metadata: DataFrame, editions: DataFrame, mapping: DataFrame) -> None:
    """The mapping's three tables as Parquet, replacing what is there; rows of the mapping are in key order."""
    metadata.coalesce(1).write.mode("overwrite").parquet(f"{folder}/metadata")
    editions.coalesce(1).write.mode("overwrite").parquet(f"{folder}/editions")
    keys = ["edition_id", "surah", "ayah", "hafs_ayah"]
    mapping.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(f"{folder}/ayah_hafs_map")


def metadata_rows(spark: SparkSession, values: dict) -> DataFrame:
    return spark.createDataFrame([(k, str(v)) for k, v in values.items()], S.METADATA)


# The pages that the summaries of a styled and of a converted document show.
STYLED_PAGES = (1, 2, 440, 598, 604)
DOCUMENT_PAGES = (1, 2, 34, 35, 598, 604)


def sample_pages(pages: DataFrame, numbers: tuple[int, ...] = STYLED_PAGES, show: Callable = print, totals: dict | None = None) -> None:
    """A summary for the console: the ``totals`` of a build, if given, and the chapters and lines of some pages."""
    if totals is not None:
        show(", ".join(f"{k}: {v}" for k, v in totals.items()))
    for r in pages.filter(F.col("page").isin(*numbers)).select("page", "surah_ids", F.size("lines").alias("n")).orderBy("page").collect():
        show(f"page {r.page}: chapters {list(r.surah_ids)}, {r.n} lines")
