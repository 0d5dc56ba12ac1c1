"""The three corpora end to end."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.operators import corpus, dedup, speech, split, stats
from weft.operators.append import IndexedTable
from weft.sources import readers, writers
from weft.staging import staged


@dataclass(frozen=True)
class SpeechConfig:
    """What the speech corpus is made with."""

    seed: int = 42
    tenths: int = 9
    shard_rows: int = 2000
    rate: int = 16_000
    sentences_only: bool = False


@dataclass(frozen=True)
class WebConfig:
    """What the web corpus is made with (S12): where a data set comes from and goes to, its name, which source and
    language are taken from, and whether it is added to what is there."""

    source: str
    target: str
    repo: str
    append: bool = False
    attempts: int = 5
    wait: float = 30.0


@dataclass(frozen=True)
class BookConfig:
    """What the file corpus is made with."""

    sources: tuple[readers.FileSource, ...]
    output: str
    excluded: tuple[str, ...] = ()
    seed: int = 42
    tenths: int = 9
    min_words: int = 50
    min_latin_ratio: float = 0.4


def run_web(spark: SparkSession, config: WebConfig) -> DataFrame:
    """Read, clean, enrich and publish a data set, and keep the states of its card beside it. An append reads the
    target's hash index, not the target, and adds a state; replacing the target makes both anew. Returns
    (rows, added, removed), one row."""
    made, states = web_corpus(readers.dataset(spark, config.source), config.repo), card_path(config)
    table = IndexedTable(spark, config.target, then=lambda new, name: stats.add_to_card(new, states, name))
    if config.append and readers.exists(spark, config.target):
        return table.append(made)
    made = staged(made, "web")
    writers.publish(made, config.target, config.attempts, config.wait)
    table.index.rebuild(made)
    writers.remove(spark, states)
    n = stats.add_to_card(made, states, "first").filter("kind = 'total'").agg(F.coalesce(F.sum("documents"), F.lit(0))).first()[0]
    return spark.createDataFrame([(n, n, 0)], "rows long, added long, removed long")


def card_path(config: WebConfig) -> str:
    return config.target.rstrip("/") + ".card"


def web_card(spark: SparkSession, config: WebConfig, existing: str | None = None) -> str:
    """The card of a web corpus from its states: the corpus is not read (K7)."""
    source, language = corpus.name_labels(config.repo)
    return stats.render_state(stats.merged(spark.read.parquet(card_path(config))), source, language, existing)


def run_books(spark: SparkSession, config: BookConfig) -> DataFrame:
    """Make the file corpus and write it as JSON lines by split (K1). Returns what was written."""
    records = corpus.file_corpus(readers.text_files(spark, list(config.sources), config.excluded), config.min_words, config.min_latin_ratio)
    rows = staged(split.assign_split(staged(records, "records"), F.col("id"), config.seed, config.tenths), "books")
    writers.write_jsonl(rows, config.output)
    return rows


def web_corpus(raw: DataFrame, repo: str, target: DataFrame | None = None, append: bool = False) -> DataFrame:
    """Raw split-keyed rows to cleaned, filtered, enriched ones; with `append`, deduplicated against the
    target and added to it."""
    source, language = corpus.name_labels(repo)
    enriched = corpus.add_columns(corpus.use_cleaned(corpus.clean_web(raw)), source, language)
    return dedup.append_to(enriched, target) if append else enriched


def book_corpus(spark: SparkSession, sources: list[readers.FileSource], excluded: tuple[str, ...] = (), seed: int = 42) -> DataFrame:
    """A registry of text files to records with a split column."""
    records = corpus.file_corpus(readers.text_files(spark, sources, excluded))
    return split.assign_split(staged(records, "records"), F.col("id"), seed)


def speech_corpus(spark: SparkSession, transcript_folders: dict[str, str], wav_folders: list[str], config: SpeechConfig = SpeechConfig()) -> DataFrame:
    """Transcripts and recordings to segments with audio, shard and shard_name. `sentences_only` keeps the
    bounds of the audio-folder variant (1.5 to 30 s, 3 words) and the first recording of a stem."""
    texts = readers.transcripts(spark, transcript_folders)
    wavs = readers.recordings(spark, wav_folders)
    index = speech.wav_index(wavs.select("stem", "dir_ord", "path"), last_wins=not config.sentences_only)
    rows = speech.syncs(speech.with_recordings(texts, index).select("speech_type", "stem", "wav_path", F.col("path").alias("file"), "xml"))
    bounds = {} if config.sentences_only else {"min_duration": None, "max_duration": None, "min_words": 0}
    found = speech.segments(rows, **bounds).withColumns(speech.speaker_columns(F.col("stem"))).withColumnRenamed("stem", "source_file").drop("file")
    keyed = staged(found.withColumn("_id", F.concat_ws(":", "speech_type", "source_file", "idx")), "segments")
    sharded = split.shards(keyed, F.col("_id"), config.seed, config.tenths, config.shard_rows).drop("_id", "rank")
    return speech.audio_segments(sharded, wavs.select("path", "content"), config.rate)
