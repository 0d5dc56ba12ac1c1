"""Queries of the sources and sinks: each writes to a scratch folder, reads back, and has DuckDB SQL beside it."""

from __future__ import annotations

import io
import uuid
import wave

import numpy as np
from pyspark.sql import functions as F

from weft.functions import text as T
from weft.operators import dedup, speech, split
from weft.operators.append import IndexedTable
from weft.plans import fixtures as X
from weft.operators.big_files import split_lines, text_lines
from weft.plans.registry import _RANKED, _split_sql, docs, query
from weft.sources import readers, writers
from weft.staging import scratch
from weft.streaming.append import append_stream

REGISTRY = [("a", "1.txt", "isa\n\ndalawa"), ("a", "skip_2.txt", "tatlo"), ("a", "3.md", "apat"), ("b", "1.txt", "lima é"), ("b", "bad.txt", b"ok \xff end")]
TRS = """<?xml version="1.0" encoding="UTF-8"?><Trans><Episode><Section>
<Turn><Sync time="0.5"/>isa <Event desc="x"/>nawala<Sync time="2.25"/>dalawa &amp; tatlo</Turn><Turn><Other/>wala<Sync/>apat</Turn></Section></Episode></Trans>"""
#: What a transcript of TRS holds: (turn, pos, start, text).
SYNCS = [(0, 0, 0.5, "isa "), (0, 2, 2.25, "dalawa & tatlo"), (1, 1, 0.0, "apat")]
PROGRESS = ['{"split":"train","shard_idx":1,"shard_name":"x","rows":2,"mb":0.5,"ts":"t"}', "no json", '{"split":"test"}', '{"split":"train","shard_idx":1}', '{"split":"test","shard_idx":0}']
#: (rate, channels, width, seconds)
WAVES = {"r1": (16_000, 1, 2, 3.0), "r2": (8_000, 2, 2, 2.0), "r3": (44_100, 1, 2, 1.0)}
#: (stem, start, end): the last begins behind the recording's end, the fourth has no readable recording.
CUTS = [("r1", 0.5, 1.25), ("r1", 2.5, 4.0), ("r2", 0.25, 1.0), ("broken", 0.0, 1.0), ("r3", 0.5, 0.75), ("r3", 2.0, 3.0)]


def put(spark, path: str, data: bytes) -> None:
    """A small file written by the driver on any of Spark's file systems."""
    fs, at = writers._filesystem(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(data))
    out.close()


def tone(rate: int, channels: int, width: int, seconds: float) -> bytes:
    """A recording of a tone, the same in every channel."""
    n = int(rate * seconds)
    one = (np.sin(np.arange(n) * 0.05) * 9000).astype("<i2")
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes(np.repeat(one, channels).tobytes())
    return out.getvalue()


_FILES = [("a", "1.txt", "isa\n\ndalawa"), ("b", "1.txt", "lima é"), ("b", "bad.txt", "ok \ufffd end"), ("md", "3.md", "apat")]


@query("S4_S5_S6_S7_U2_file_registry", f"SELECT * FROM {X.values(_FILES, 'source, name, text', number=False)}")
def _registry(spark, sf_dir):
    root = scratch(spark, "registry")
    for folder, name, data in REGISTRY:
        put(spark, f"{root}/{folder}/{name}", data if isinstance(data, bytes) else data.encode())
    entries = [readers.FileSource(f"{root}/{d}", g, s, "fil") for d, g, s in (("a", "*.txt", "a"), ("none", "*", "x"), ("b", "*.txt", "b"), ("a", "*.md", "md"))]
    return readers.text_files(spark, entries, ("skip_",)).select("source", "name", "text")


@query("S8_M1_transcripts", f"SELECT 'read' AS speech_type, * FROM {X.values([(s, *x) for s in ('t1', 't2') for x in SYNCS], 'stem, turn, pos, start, text', number=False)}")
def _transcripts(spark, sf_dir):
    root = scratch(spark, "transcripts")
    for name, data in (("t1.trs", TRS), ("t2.trs", TRS), ("bad.trs", "<Trans><Turn>"), ("t3.txt", TRS)):
        put(spark, f"{root}/{name}", data.encode())
    return speech.syncs(readers.transcripts(spark, {"read": root, "machine": root + "/none"})).select("speech_type", "stem", "turn", "pos", "start", "text")


@query("S2_K1_jsonl", "SELECT doc_id, md5(text) AS text_hash, n_chars, lang AS split FROM documents")
def _jsonl(spark, sf_dir):
    d = docs(spark, sf_dir).withColumn("split", F.col("lang"))
    root = scratch(spark, "jsonl")
    writers.write_jsonl(d, root, ["doc_id", "text", "n_chars"])
    names = [r["split"] for r in d.select("split").distinct().collect()]  # as many as splits
    return readers.jsonl_splits(spark, {s: f"{root}/split={s}" for s in names}, "doc_id long, text string, n_chars long").select("doc_id", F.md5("text").alias("text_hash"), "n_chars", "split")


@query("S1_K4_K6_publish", "SELECT doc_id, md5(text) AS text_hash FROM documents WHERE n_chars > 200")
def _publish(spark, sf_dir):
    path = scratch(spark, "published")
    writers.publish(docs(spark, sf_dir), path, wait=0)  # makes the target
    writers.publish(readers.dataset(spark, path).filter("n_chars > 200"), path, wait=0)  # and replaces it by what it holds
    return readers.dataset(spark, path).select("doc_id", F.md5("text").alias("text_hash"))


_CLIPS = [("train", "audio/a_0000.wav", "isa", "clip 1"), ("train", "audio/a_0001.wav", "é", "clip 2"), ("test", "audio/b_0000.wav", "tatlo", "clip 3")]


@query("S3_K3_audio_folder", f"SELECT split, file_name, sentence, md5(clip) AS clip_hash FROM {X.values(_CLIPS, 'split, file_name, sentence, clip', number=False)}")
def _audio_folder(spark, sf_dir):
    root = scratch(spark, "audio-folder")
    clips = X.frame(spark, _CLIPS, "split string, file_name string, sentence string, clip string")
    writers.write_audio_folder(clips.withColumn("audio", F.struct(F.encode("clip", "UTF-8").alias("bytes"))).drop("clip"), root)
    return readers.audio_folder(spark, root).select("split", "file_name", "sentence", F.md5("content").alias("clip_hash"))


@query("S11_progress_log", "SELECT * FROM (VALUES ('train', 1), ('test', 0)) AS t(split, shard_idx)")
def _progress(spark, sf_dir):
    path = scratch(spark, "progress") + "/progress.jsonl"
    put(spark, path, "\n".join(PROGRESS).encode())
    return readers.completed_shards(spark, path)


_SHARDED = f"SELECT split, CAST(place // 200 AS INTEGER) AS shard, doc_id FROM (SELECT doc_id, CASE WHEN rank < n * 9 // 10 THEN 'train' ELSE 'test' END AS split, CASE WHEN rank < n * 9 // 10 THEN rank ELSE rank - n * 9 // 10 END AS place FROM {_RANKED})"


@query("K2_K5_R2_F13_resumed_shards", f"SELECT split, shard AS shard_idx, count(*) AS rows, CAST(sum(doc_id) AS BIGINT) AS ids FROM ({_SHARDED}) WHERE NOT (split = 'train' AND shard = 0) GROUP BY split, shard")
def _resumed(spark, sf_dir):
    """A first run ends after one shard; the second writes the others, which are read back from their files."""
    root = scratch(spark, "shards")
    rows = split.shards(docs(spark, sf_dir).select("doc_id"), F.col("doc_id"), shard_rows=200).drop("rank")
    writers.write_shards(rows.filter("split = 'train' and shard = 0"), root, root + "-log")
    now = writers.write_shards(rows, root, root + "-log")
    held = spark.read.parquet(root).groupBy(F.regexp_extract(F.input_file_name(), "([^/]+)$", 1).alias("shard_name")).agg(F.count("*").alias("rows"), F.sum("doc_id").alias("ids"))
    return now.drop("rows").join(held, "shard_name").select("split", "shard_idx", "rows", "ids")


_FRAMES = [(s, i, int(e * 16_000) - int(b * 16_000) if s != "r1" or e < 3 else 48_000 - int(b * 16_000)) for i, (s, b, e) in enumerate(CUTS) if s in WAVES and b < WAVES[s][3]]


@query("V1_V2_V3_V4_V5_V7_R4_F11_clips", f"SELECT source_file, idx, frames FROM {X.values(_FRAMES, 'source_file, idx, frames', number=False)}")
def _clips(spark, sf_dir):
    """Frames of the clips (16 kHz, mono, 16 bits, 44 bytes of header); empty and unreadable ones are left out."""
    root = scratch(spark, "recordings")
    for stem, form in WAVES.items():
        put(spark, f"{root}/{stem}.wav", tone(*form))
    put(spark, f"{root}/broken.wav", b"RIFF")
    wavs = readers.recordings(spark, [root])
    found = X.frame(spark, [(s, i, b, e) for i, (s, b, e) in enumerate(CUTS)], "stem string, idx int, start double, end double")
    located = speech.with_recordings(found, speech.wav_index(wavs)).withColumnRenamed("stem", "source_file")
    return speech.audio_segments(located, wavs.select("path", "content")).select("source_file", "idx", ((F.octet_length("audio.bytes") - 44) / 2).cast("int").alias("frames"))


@query("U1_D1_append_stream", "SELECT doc_id FROM documents WHERE lang = 'en' OR md5(coalesce(text, '')) NOT IN (SELECT md5(coalesce(text, '')) FROM documents WHERE lang = 'en')")
def _stream(spark, sf_dir):
    """English documents are a table; a stream of all others is appended to it."""
    root = scratch(spark, "stream")
    d = docs(spark, sf_dir).withColumn("content_hash", T.content_hash(F.col("text")))
    d.filter("lang = 'en'").write.parquet(root + "/table")
    d.filter("lang <> 'en'").write.parquet(root + "/in")
    stream = spark.readStream.schema(d.schema).parquet(root + "/in")
    append_stream(stream, root + "/table", root + "/log").awaitTermination()
    return spark.read.parquet(root + "/table").select("doc_id")


_HASH = "md5(coalesce(text, ''))"


@query("U1_D1_indexed_append", f"SELECT doc_id, lang FROM documents WHERE lang = 'en' OR (lang = 'de' AND {_HASH} NOT IN (SELECT {_HASH} FROM documents WHERE lang = 'en')) OR (lang NOT IN ('en', 'de') AND {_HASH} NOT IN (SELECT {_HASH} FROM documents WHERE lang IN ('en', 'de')))")
def _indexed(spark, sf_dir):
    """English documents are a table; German ones, then all others, are appended through its hash index."""
    root, d = scratch(spark, "indexed"), docs(spark, sf_dir)
    d.filter("lang = 'en'").write.parquet(root + "/table")
    table = IndexedTable(spark, root + "/table")
    table.append(d.filter("lang = 'de'"))
    table.append(d.filter("lang not in ('en', 'de')"))
    return table.rows().select("doc_id", "lang")


@query("S1_K4_K6_U1_catalog_table", "SELECT doc_id, n_chars, CASE WHEN lang <> 'en' THEN md5(text) END AS text_hash FROM documents WHERE n_chars > 200 OR lang <> 'en'")
def _catalog(spark, sf_dir):
    """A table of the catalog is made of the English documents, replaced by the longer of its own rows, and appended
    to by the others, which have a column more."""
    name, root, d = f"weft_{uuid.uuid4().hex}", scratch(spark, "catalog"), docs(spark, sf_dir)
    writers.publish_table(d.filter("lang = 'en'").select("doc_id", "n_chars"), name, root)
    writers.publish_table(readers.dataset(spark, name).filter("n_chars > 200"), name, root)
    writers.append_table(d.filter("lang <> 'en'").select(F.md5("text").alias("text_hash"), "doc_id", "n_chars"), name)
    out = readers.dataset(spark, name).select("doc_id", "n_chars", "text_hash")
    spark.sql(f"DROP TABLE {name}")  # its files stay, as they lie at a location of their own
    return out


_JOINED = "(SELECT coalesce(source, '') AS id, string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY doc_id) || chr(10) AS text FROM documents GROUP BY 1)"


@query("S7_X1_X2_big_files", f"SELECT id AS source, pos, md5(doc) AS doc_hash FROM ({_split_sql(_JOINED)})")
def _big_files(spark, sf_dir):
    """All documents of a source are one file, which is read in splits."""
    root = scratch(spark, "big-files")
    rows = docs(spark, sf_dir).select("doc_id", F.coalesce("source", F.lit("")).alias("source"), F.concat(F.lit("x"), F.coalesce("source", F.lit(""))).alias("of"), F.coalesce("text", F.lit("")).alias("text"))
    rows.repartition("of").sortWithinPartitions("of", "doc_id").select("of", "text").write.partitionBy("of").option("lineSep", "\n\n").text(root)
    lines = text_lines(spark, root).withColumn("of", F.col("of").cast("string"))
    return split_lines(lines, ["of"]).select(F.substring("of", 2, 1 << 20).alias("source"), "pos", F.md5("doc").alias("doc_hash"))


@query("D1_within_first", "SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY md5(coalesce(text, '')) ORDER BY doc_id) = 1")
def _within(spark, sf_dir):
    """The order of the input is that of doc_id; a range holds some 64 MB of texts, whatever the table's size."""
    d = docs(spark, sf_dir)
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return dedup.dedup_against(d.repartitionByRange(max(4, -(-size // (64 << 20))), "doc_id").sortWithinPartitions("doc_id"), None, within=True).select("doc_id")
