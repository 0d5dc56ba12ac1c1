import io
import wave

import numpy as np
from pyspark.sql import functions as F

from weft.operators import speech
from weft.plans import pipelines

TRS = """<?xml version="1.0"?><Trans><Episode><Section><Turn><Sync time="0.0"/>isa dalawa tatlo &amp; apat
<Sync time="2.0"/>lima anim pito<Event desc="x"/>hindi kasama<Sync time="4.5"/>..
<Sync time="5.0"/>(ubo)</Turn><Turn><Sync/>walo siyam sampu</Turn></Section></Episode></Trans>"""


def wav(seconds: float, rate: int = 16_000, channels: int = 1, width: int = 2) -> bytes:
    t = np.arange(int(seconds * rate)) / rate
    x = np.repeat((np.sin(2 * np.pi * 440 * t) * 0.5)[:, None], channels, axis=1)
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes((x * 32767).astype("<i2").tobytes() if width == 2 else ((x + 1) * 127).astype(np.uint8).tobytes())
    return out.getvalue()


def test_parse_transcript_keeps_only_direct_tails():
    got = speech.parse_transcript(TRS)
    assert [(x["turn"], x["start"], x["text"].strip()) for x in got] == [(0, 0.0, "isa dalawa tatlo & apat"), (0, 2.0, "lima anim pito"), (0, 4.5, ".."), (0, 5.0, "(ubo)"), (1, 0.0, "walo siyam sampu")]
    assert speech.parse_transcript("<Trans><Turn>") is None and speech.parse_transcript(None) is None
    assert speech.parse_transcript('<!DOCTYPE x [<!ENTITY a "b">]><x/>') is None


def test_wav_round_trip_and_mono():
    for channels, width in ((1, 2), (2, 2), (1, 1)):
        samples, rate = speech.decode_wav(wav(0.5, 8000, channels, width))
        assert rate == 8000 and len(samples) == 4000 and abs(samples).max() < 0.52
    again, rate = speech.decode_wav(speech.encode_wav(samples, 8000))
    assert rate == 8000 and np.abs(again - samples).max() < 1e-4


def test_resample_keeps_a_tone():
    for rate in (8000, 44_100):
        x = np.sin(2 * np.pi * 300 * np.arange(rate) / rate)
        y = speech.resample(x, rate, 16_000)
        expect = np.sin(2 * np.pi * 300 * np.arange(16_000) / 16_000)
        assert len(y) == 16_000 and np.abs(y - expect)[500:-500].max() < 0.02


def test_clip_bounds():
    x = np.ones(16_000)
    assert len(speech.decode_wav(speech.cut_clip(x, 16_000, 0.5, 9))[0]) == 8000
    assert speech.cut_clip(x, 16_000, 2, 3) is None


def test_speech_corpus(spark, tmp_path):
    for folder in ("read", "v1", "v2/deep"):
        (tmp_path / folder).mkdir(parents=True)
    (tmp_path / "read/12_xx13xxxx_7.trs").write_text(TRS)
    (tmp_path / "read/no_wav.trs").write_text(TRS)
    (tmp_path / "read/broken.trs").write_text("<Trans>")
    (tmp_path / "read/bad.trs").write_text(TRS)
    (tmp_path / "v1/broken.wav").write_bytes(wav(1))
    (tmp_path / "v1/bad.wav").write_bytes(b"not a recording")
    (tmp_path / "v2/deep/12_xx13xxxx_7.wav").write_bytes(wav(4.0, 8000, 2))
    args = ({"read": str(tmp_path / "read"), "gone": str(tmp_path / "none")}, [str(tmp_path / "v1"), str(tmp_path / "v2"), str(tmp_path / "none")])
    rows = pipelines.speech_corpus(spark, *args).orderBy("idx").collect()
    assert [(r["idx"], r["sentence"], r["num_words"], r["duration"]) for r in rows] == [(0, "isa dalawa tatlo & apat", 5, 2.0), (1, "lima anim pito", 3, 2.5), (2, "walo siyam sampu", 3, 5.0)]
    assert {(r["speaker_id"], r["gender"], r["age_group"], r["speech_type"], r["source_file"]) for r in rows} == {("12", "female", "44-51", "read", "12_xx13xxxx_7")}
    lengths = [len(speech.decode_wav(bytes(r["audio"]["bytes"]))[0]) for r in rows]
    assert lengths == [32_000, 32_000, 64_000]  # the second and third run past the recording's end
    assert pipelines.speech_corpus(spark, *args, pipelines.SpeechConfig(sentences_only=True)).count() == 3


def test_segments_do_not_depend_on_partitions(spark):
    from weft.plans import fixtures as X

    base = X.frame(spark, X.SYNCS, "file string, turn int, pos int, start double, text string")
    results = [sorted(map(tuple, speech.segments(base.repartition(n, F.rand(n))).collect())) for n in (1, 2, 8)]
    assert results[0] == results[1] == results[2]
