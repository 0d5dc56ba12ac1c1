"""Transcripts and recordings into sentence segments."""

from __future__ import annotations

import io
import math
import wave
from xml.etree import ElementTree

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructType

from weft.functions import text as T
from weft.session import ship
from weft.staging import staged

#: Age groups by their digit.
AGE_GROUPS = ["20-27", "28-35", "36-43", "44-51", "52-60"]
#: Fixed value: a file's stem, with speaker, gender digit and age digit.
STEM = r"^(\d+)_xx(\d)(\d)xxxx_(\d+)"
LAST_SEGMENT = 5.0
SYNCS = ArrayType(StructType().add("turn", IntegerType()).add("pos", IntegerType()).add("start", DoubleType()).add("text", StringType()))


def speaker_columns(stem: Column) -> dict[str, Column]:
    """speaker_id, gender and age_group of a file's stem (P10)."""
    hit = stem.rlike("(?U)" + STEM)
    part = lambda i: F.regexp_extract(stem, "(?U)" + STEM, i)
    ages = F.array(*map(F.lit, AGE_GROUPS))
    return {
        "speaker_id": F.when(hit, part(1)).otherwise(stem),
        "gender": F.when(hit, F.when(part(2) == "1", "female").otherwise("male")).otherwise("unknown"),
        "age_group": F.when(hit, F.coalesce(F.try_element_at(ages, part(3).try_cast("int") + 1), F.lit("unknown"))).otherwise("unknown"),
    }


def parse_transcript(xml: str | None) -> list[dict] | None:
    """Every Sync that is a child of a Turn, with its tail text (M1). None for XML that does not parse or
    that declares entities; a time that is no number stops the run."""
    if xml is None or "<!ENTITY" in xml:
        return None
    try:
        root = ElementTree.fromstring(xml)
    except ElementTree.ParseError:
        return None
    return [{"turn": t, "pos": p, "start": float(e.get("time", 0)), "text": e.tail or ""} for t, turn in enumerate(root.iter("Turn")) for p, e in enumerate(turn) if e.tag == "Sync"]


@F.pandas_udf(SYNCS)
def _parsed(xml: pd.Series) -> pd.Series:
    return xml.map(parse_transcript)


def syncs(transcripts: DataFrame, xml: str = "xml") -> DataFrame:
    """A row for each Sync of every transcript: the other columns, turn, pos, start, text."""
    ship(transcripts.sparkSession)
    rest = [c for c in transcripts.columns if c != xml]
    return transcripts.select(*rest, F.explode(_parsed(F.col(xml))).alias("s")).select(*rest, "s.*")


def segments(rows: DataFrame, file: str = "file", min_duration: float | None = 1.5, max_duration: float | None = 30.0, min_words: int = 3) -> DataFrame:
    """Sentence segments of Syncs (file, turn, pos, start, text): ends (W1), skips (F6, F7), durations
    (F8; None bounds keep any above 0), words (F9), index within the file (W2), and P8's columns."""
    end = F.coalesce(F.lead("start").over(Window.partitionBy(file, "turn").orderBy("pos")), F.col("start") + LAST_SEGMENT)
    df = rows.withColumn("end", end).withColumn("_text", T.strip(F.coalesce("text", F.lit(""))))
    df = df.filter(~F.col("_text").rlike(r"(?sdU)^(?:\.\.|\{.*\}|)$"))
    df = df.withColumn("sentence", T.clean_sentence(F.col("_text"))).filter("sentence <> ''")
    length = F.col("end") - F.col("start")
    df = df.filter((length > 0) & (length >= (min_duration or 0)) & (length <= (max_duration if max_duration is not None else float("inf"))))
    df = df.withColumn("num_words", T.word_count(F.col("sentence"))).filter(F.col("num_words") >= min_words)
    idx = (F.row_number().over(Window.partitionBy(file).orderBy("turn", "pos")) - 1).alias("idx")
    rest = [c for c in rows.columns if c not in ("turn", "pos", "start", "text")]
    return df.select(*rest, idx, "start", "end", "sentence", F.round(length, 3).alias("duration"), "num_words")


def clip_name(stem: Column, idx: Column) -> Column:
    return F.format_string("%s_%04d.wav", stem, idx)


def asr_rows(df: DataFrame) -> DataFrame:
    """Segments fit for recognition."""
    return df.filter("num_words >= 3 and duration >= 1.5")


def tts_rows(df: DataFrame) -> DataFrame:
    """Segments fit for synthesis."""
    return df.filter("speech_type = 'read' and duration between 1.0 and 10.0")


def wav_index(files: DataFrame, last_wins: bool = True) -> DataFrame:
    """(stem, path) of recordings (stem, dir_ord, path): the last directory's hit (S10) or the first's."""
    pick = F.max_by if last_wins else F.min_by
    return files.groupBy("stem").agg(pick("path", F.struct("dir_ord", "path")).alias("path"))


def with_recordings(transcripts: DataFrame, index: DataFrame) -> DataFrame:
    """Transcripts that have a recording, with its wav_path."""
    return transcripts.join(index.select("stem", F.col("path").alias("wav_path")), "stem")


def without_recordings(transcripts: DataFrame, index: DataFrame) -> DataFrame:
    return transcripts.join(index, "stem", "left_anti")


def skipped_counts(transcripts: DataFrame, index: DataFrame, found: DataFrame) -> DataFrame:
    """Files without a recording, and files with one but without any segment."""
    missing = without_recordings(transcripts, index).agg(F.count("*").alias("no_wav"))
    silent = with_recordings(transcripts, index).join(found.select("stem").distinct(), "stem", "left_anti").agg(F.count("*").alias("no_segments"))
    return missing.crossJoin(silent)  # one row each


def decode_wav(data: bytes) -> tuple[np.ndarray, int]:
    """Mono samples in [-1, 1] and the rate (V1, V2): channels are averaged."""
    with wave.open(io.BytesIO(data)) as w:
        width, rate, channels = w.getsampwidth(), w.getframerate(), w.getnchannels()
        raw = w.readframes(w.getnframes())
    if width == 1:
        samples = (np.frombuffer(raw, np.uint8).astype(np.float64) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        samples = ((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) << 8 >> 8) / 2**23
    else:
        samples = np.frombuffer(raw, {2: "<i2", 4: "<i4"}[width]).astype(np.float64) / 2 ** (8 * width - 1)
    return samples.reshape(-1, channels).mean(axis=1), rate


def resample(samples: np.ndarray, rate: int, target: int, taps: int = 32) -> np.ndarray:
    """Windowed-sinc resampling (V3), with ceil(n * target / rate) samples. Not bit-equal to other
    resamplers."""
    if rate == target or not len(samples):
        return samples
    n = math.ceil(len(samples) * target / rate)
    cut = min(1.0, target / rate)
    half = math.ceil(taps / cut)
    out = np.empty(n)
    padded = np.pad(samples, half + 1)
    offsets = np.arange(-half, half + 1)
    for begin in range(0, n, 8192):
        at = np.arange(begin, min(n, begin + 8192)) * (rate / target)
        base = np.floor(at).astype(np.int64)
        d = offsets[None, :] - (at - base)[:, None]
        weights = cut * np.sinc(cut * d) * (0.5 + 0.5 * np.cos(np.pi * np.clip(d / (half + 1), -1, 1)))
        out[begin : begin + len(at)] = (padded[base[:, None] + offsets[None, :] + half + 1] * weights).sum(axis=1)
    return out


def encode_wav(samples: np.ndarray, rate: int) -> bytes:
    """A 16-bit mono WAV file (V5)."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(samples, -1, 1 - 2**-15) * 2**15).round().astype("<i2").tobytes())
    return out.getvalue()


def cut_clip(samples: np.ndarray, rate: int, start: float, end: float) -> bytes | None:
    """The WAV file of [start, end) seconds, or None where it is empty."""
    part = samples[int(start * rate) : int(end * rate)]
    return encode_wav(part, rate) if len(part) else None


def audio_segments(found: DataFrame, recordings: DataFrame, rate: int = 16_000) -> DataFrame:
    """found (with wav_path, start, end) with audio struct(bytes, path); each recording (path, content) is
    read once for all its segments (R4). Unreadable recordings and empty clips give no rows."""
    ship(found.sparkSession)
    rest = [c for c in found.columns if c not in ("wav_path", "start", "end")]
    # One recording's segments a row: as many as its transcript has. Staged, so that its size is known and
    # Spark broadcasts it where it is small, and no recording is shuffled then.
    gathered = staged(found.groupBy("wav_path").agg(F.collect_list(F.struct("start", "end", *rest)).alias("segs")), "segments")
    joined = gathered.join(recordings.select(F.col("path").alias("wav_path"), "content"), "wav_path")

    @F.pandas_udf("array<binary>")
    def clips(content: pd.Series, segs: pd.Series) -> pd.Series:
        out = []
        for data, some in zip(content, segs):
            try:
                samples, own = decode_wav(bytes(data))
            except (wave.Error, EOFError, KeyError, ValueError):
                out.append([None] * len(some))
                continue
            samples = resample(samples, own, rate)
            out.append([cut_clip(samples, rate, s["start"], s["end"]) for s in some])
        return pd.Series(out)

    cut = joined.select(F.explode(F.arrays_zip("segs", clips("content", "segs").alias("clip"))).alias("x"))
    return cut.filter("x.clip is not null").select(F.struct(F.col("x.clip").alias("bytes"), F.lit(None).cast("string").alias("path")).alias("audio", metadata={"sampling_rate": rate}), *[F.col(f"x.segs.{c}").alias(c) for c in rest])
