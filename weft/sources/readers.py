"""Sources: split-keyed tables, JSONL, audio folders, file registries, transcripts, progress logs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class FileSource:
    """An entry of the file registry (S4): a folder, a glob of names, a label and a language."""

    folder: str
    glob: str
    source: str
    language: str


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its own file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def dataset(spark: SparkSession, path: str, table: bool | None = None) -> DataFrame:
    """A split-keyed data set (S1): Parquet below split=<name> folders, or with `table` the catalog's table of that
    name. Where that is not said, a name that the catalog has is its table."""
    if table is None:
        table = "/" not in path and spark.catalog.tableExists(path)
    return spark.table(path) if table else spark.read.parquet(path)


def jsonl_splits(spark: SparkSession, files: dict[str, str], schema: str | StructType) -> DataFrame:
    """JSONL files by split name, with a split column."""
    parts = [spark.read.schema(schema).json(path).withColumn("split", F.lit(split)) for split, path in files.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def audio_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of <split>/metadata.jsonl with split and the clips' bytes as content (S3)."""
    meta = spark.read.json(f"{folder}/*/metadata.jsonl").withColumn("split", F.regexp_extract(F.input_file_name(), r"([^/]+)/metadata\.jsonl(?:/|$)", 1))
    clips = spark.read.format("binaryFile").load(f"{folder}/*/audio/*.wav").select(F.regexp_extract("path", r"([^/]+)/audio/[^/]+$", 1).alias("split"), F.regexp_extract("path", r"(audio/[^/]+)$", 1).alias("file_name"), "content")
    return meta.join(clips, ["split", "file_name"])


def text_files(spark: SparkSession, sources: list[FileSource], excluded: tuple[str, ...] = ()) -> DataFrame:
    """(source_ord, source, language, name, path, text) of every file of a registry (S5-S7, O2): missing
    folders are skipped, names that begin with an excluded prefix left out, bad UTF-8 becomes U+FFFD."""
    schema = "source_ord int, source string, language string, name string, path string, text string"
    out = spark.createDataFrame([], schema)
    for k, s in enumerate(sources):
        if not exists(spark, s.folder):
            continue
        files = spark.read.format("binaryFile").option("pathGlobFilter", s.glob).load(s.folder)
        name = F.col("_metadata.file_name")
        files = files.select(F.lit(k).alias("source_ord"), F.lit(s.source).alias("source"), F.lit(s.language).alias("language"), name.alias("name"), "path", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))
        for prefix in excluded:
            files = files.filter(~F.col("name").startswith(prefix))
        out = out.unionByName(files)
    return out


def transcripts(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """(speech_type, stem, path, xml) of the .trs files of each speech type's folder."""
    out = spark.createDataFrame([], "speech_type string, stem string, path string, xml string")
    for kind, folder in folders.items():
        if exists(spark, folder):
            files = spark.read.format("binaryFile").option("pathGlobFilter", "*.trs").load(folder)
            stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.trs$", "")
            out = out.unionByName(files.select(F.lit(kind).alias("speech_type"), stem.alias("stem"), "path", F.make_valid_utf8(F.col("content").cast("string")).alias("xml")))
    return out


def recordings(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(dir_ord, stem, path, content) of the .wav files below each folder; content is read only where used."""
    out = spark.createDataFrame([], "dir_ord int, stem string, path string, content binary")
    for k, folder in enumerate(folders):
        if exists(spark, folder):
            files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").option("recursiveFileLookup", "true").load(folder)
            stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.wav$", "")
            out = out.unionByName(files.select(F.lit(k).alias("dir_ord"), stem.alias("stem"), "path", "content"))
    return out


PROGRESS = "split string, shard_idx int, shard_name string, rows long, mb double, ts string, run string"


def completed_shards(spark: SparkSession, path: str) -> DataFrame:
    """Distinct (split, shard_idx) of a progress log; bad lines and lines without them are left out."""
    if not exists(spark, path):
        return spark.createDataFrame([], "split string, shard_idx int")
    return spark.read.schema(PROGRESS).option("mode", "PERMISSIVE").json(path).select("split", "shard_idx").dropna().distinct()
