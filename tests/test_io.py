import json

import pytest
from pyspark.sql import functions as F

from weft.operators import corpus, dedup, split, stats
from weft.plans import pipelines
from weft.sources import readers, writers
from weft.streaming.append import append_stream


def test_file_registry_and_book_corpus(spark, tmp_path):
    (tmp_path / "a").mkdir()
    long = "\n".join(["salita " * 30] * 20)
    (tmp_path / "a/1.txt").write_text(long)
    (tmp_path / "a/2.txt").write_bytes(b"maikli \xff lamang")
    (tmp_path / "a/1900_1909.txt").write_text(long)
    (tmp_path / "a/3.md").write_text(long)
    sources = [readers.FileSource(str(tmp_path / "a"), "*.txt", "aklat", "fil"), readers.FileSource(str(tmp_path / "none"), "*", "x", "fil"), readers.FileSource(str(tmp_path / "a"), "*.md", "muli", "fil")]
    files = readers.text_files(spark, sources, ("1900_1909.txt",)).collect()
    assert sorted(r["name"] for r in files) == ["1.txt", "2.txt", "3.md"]
    assert next(r["text"] for r in files if r["name"] == "2.txt") == "maikli � lamang"
    rows = pipelines.book_corpus(spark, sources, ("1900_1909.txt",)).collect()
    assert {r["source"] for r in rows} == {"aklat"} and all(r["id"].startswith("aklat_00000") for r in rows)
    assert sum(r["token_count"] for r in rows) == 210 + 180 and len(rows) == 2  # 210, 210 (a copy), 180


def test_jsonl_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("é\n", None, "train"), ("b", 2, "test")], "text string, n int, split string")
    writers.write_jsonl(rows, str(tmp_path / "out"))
    lines = [json.loads(x) for p in (tmp_path / "out/split=train").glob("*.json") for x in p.read_text().splitlines()]
    assert lines == [{"text": "é\n", "n": None}] and list(lines[0]) == ["text", "n"]
    back = readers.jsonl_splits(spark, {s: str(tmp_path / f"out/split={s}") for s in ("train", "test")}, "text string, n int")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)


def test_shards_resume(spark, tmp_path):
    df = split.shards(spark.range(950).select(F.col("id").cast("string").alias("id")), F.col("id"), shard_rows=100).drop("rank")
    out, progress = str(tmp_path / "shards"), str(tmp_path / "progress")
    first = writers.write_shards(df.filter("split = 'train' and shard < 3"), out, progress).collect()
    assert [(r["shard_idx"], r["rows"]) for r in first] == [(0, 100), (1, 100), (2, 100)]
    rest = writers.write_shards(df, out, progress).collect()
    assert {(r["split"], r["shard_idx"]) for r in rest} == {("train", k) for k in range(3, 9)} | {("test", 0)}
    assert (tmp_path / "shards/train-00000-of-00009.parquet").exists() and writers.write_shards(df, out, progress).count() == 0
    assert spark.read.parquet(out).count() == 950


def test_completed_shards_tolerates_bad_lines(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"split":"train","shard_idx":1}\nnot json\n{"split":"test"}\n{"split":"train","shard_idx":1}\n')
    assert [tuple(r) for r in readers.completed_shards(spark, str(tmp_path / "p.jsonl")).collect()] == [("train", 1)]
    assert readers.completed_shards(spark, str(tmp_path / "absent")).count() == 0


def test_audio_folder_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("train", "audio/a_0000.wav", "isa", b"RIFF1"), ("test", "audio/b_0000.wav", "dalawa", b"RIFF2")], "split string, file_name string, sentence string, data binary").withColumn("audio", F.struct(F.col("data").alias("bytes"))).drop("data")
    writers.write_audio_folder(df, f"file://{tmp_path}/af")
    back = readers.audio_folder(spark, f"{tmp_path}/af").select("split", "file_name", "sentence", "content").collect()
    assert sorted((r[0], r[1], r[2], bytes(r[3])) for r in back) == [("test", "audio/b_0000.wav", "dalawa", b"RIFF2"), ("train", "audio/a_0000.wav", "isa", b"RIFF1")]


def test_replace_table_may_read_its_target(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.publish(spark.range(3), path)
    writers.publish(readers.dataset(spark, path).filter("id > 0"), path)
    assert spark.read.parquet(path).count() == 2


def test_retry_gives_up():
    calls = []

    def fail():
        calls.append(1)
        raise OSError

    with pytest.raises(OSError):
        writers.with_retry(fail, attempts=3, wait=0)
    assert len(calls) == 3


def test_append_is_idempotent_and_keeps_copies_in_a_batch(spark):
    new = spark.createDataFrame([("train", "a"), ("train", "a"), ("dev", "b")], "split string, text string")
    old = spark.createDataFrame([("train", "b", None), ("test", "c", "stale")], "split string, text string, content_hash string")
    once = dedup.append_to(new, old)
    assert sorted(map(tuple, once.select("split", "text").collect())) == [("test", "c"), ("train", "a"), ("train", "a"), ("train", "b")]
    assert dedup.append_to(new, once.drop("content_hash")).count() == once.count()
    assert dedup.append_to(new, old, within=True).count() == 3 and dedup.append_to(new, None).count() == 3


def test_append_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    spark.createDataFrame([("a",), ("b",)], "text string").write.parquet(str(tmp_path / "in/1"))
    for _ in range(2):
        stream = spark.readStream.schema("text string").parquet(str(tmp_path / "in/*"))
        append_stream(stream, str(tmp_path / "t"), str(tmp_path / "cp")).awaitTermination()
        spark.createDataFrame([("b",), ("c",)], "text string").write.mode("overwrite").parquet(str(tmp_path / "in/2"))
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == ["a", "b", "c"]


def test_split_is_exact_and_stable(spark):
    rows = spark.range(1234).select(F.col("id").cast("string").alias("id"))
    got = {r["id"]: r["split"] for r in split.train_test(rows.repartition(7), F.col("id")).collect()}
    assert sum(s == "train" for s in got.values()) == int(1234 * 0.9) and len(got) == 1234
    assert got == {r["id"]: r["split"] for r in split.train_test(rows.coalesce(1), F.col("id")).collect()}


def test_card(spark):
    df = corpus.add_columns(spark.createDataFrame([("isa dalawa",), ("tatlo",)], "text string"), "s", "fil")
    card = stats.render_card(df, "set", "fil", "---\nlicense: x\n---\nold")
    assert card.startswith("---\nlicense: x\n---\n\n# set") and "| **Total** | **2** | **3** |" in card and "old" not in card
    assert stats.append_card(stats.append_card("c", "one", "m"), "two", "m") == "c\n\n<!-- m -->\ntwo\n"


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "text string, id string")
    assert split.train_test(empty, F.col("id")).count() == 0
    assert stats.totals(corpus.add_columns(empty, "s", "l")).first()["avg_tokens"] == 0


def test_swap_is_finished_after_it_stops_anywhere(spark, tmp_path):
    """Whatever the step a swap stopped at, a table is there and another swap ends it."""
    new, old = spark.range(5), spark.range(2)
    for stopped in ("written", "moved aside", "moved in"):
        path = tmp_path / stopped.replace(" ", "")
        old.write.parquet(str(path))
        new.write.parquet(f"{path}.staged")
        if stopped != "written":
            path.rename(f"{path}.old")
        if stopped == "moved in":
            (tmp_path / f"{path.name}.staged").rename(path)
        assert any((tmp_path / f"{path.name}{end}").exists() for end in ("", ".old"))
        writers.swap(spark, str(path))
        assert spark.read.parquet(str(path)).count() == 5 and not (tmp_path / f"{path.name}.old").exists()


def test_publish_survives_a_failing_swap(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    writers.publish(spark.range(3), path)
    renamed, calls = writers._renamed, []

    def sometimes(fs, source, target):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("transient")
        renamed(fs, source, target)

    monkeypatch.setattr(writers, "_renamed", sometimes)
    writers.publish(spark.read.parquet(path).filter("id > 0"), path, wait=0)
    assert spark.read.parquet(path).count() == 2


def test_running_index_keeps_null_keys(spark):
    rows = spark.createDataFrame([(None, "f", 1), (None, None, 2), ("s", None, 1), ("s", "f", 1)], "source string, file string, pos int")
    got = {tuple(r) for r in corpus.running_index(rows, "source", "file", "pos").collect()}
    assert got == {(None, "f", 1, 1), (None, None, 2, 0), ("s", None, 1, 0), ("s", "f", 1, 1)}


def test_logging_goes_to_a_file(tmp_path):
    from weft.session import setup_logging

    log = setup_logging(str(tmp_path / "logs/run.log"))
    log.info("hello")
    assert " INFO hello" in (tmp_path / "logs/run.log").read_text()
    setup_logging()


def test_files_by_source_lists_sources_without_documents(spark):
    files = spark.createDataFrame([("a", "fil"), ("a", "fil"), ("b", None)], "source string, language string")
    got = {tuple(r) for r in stats.files_by_source(files.filter("source = 'a'").limit(1), files).collect()}
    assert got == {("a", "fil", 1, 2), ("b", None, 0, 1)}
