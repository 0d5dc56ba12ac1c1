"""Files cut at any offset against the whole-file way, and runners of the corpora by their configuration."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from weft.operators import big_files, corpus, stats
from weft.operators.big_files import split_lines, text_lines, walk
from weft.plans import pipelines
from weft.sources import readers
from weft.sources.cards import Card


def files():
    """Paragraphs of all lengths, one paragraph of many lines or of one, blank and white lines at borders, odd line ends."""
    rng = np.random.default_rng(9)
    words = lambda n: " ".join(rng.choice(["salita", "ng", "bayan", "é", "ñandú", "x\x85y", " z"], n))
    out = {f"f{k}": "\n\n".join(words(int(n)) for n in rng.integers(1, 90, int(rng.integers(1, 40)))) for k in range(12)}
    out |= {f"g{k}": "\n".join(words(int(n)) for n in rng.integers(1, 60, 30)) for k in range(4)}
    out |= {"long": "\n\n".join(words(300) for _ in range(8)), "one": "isa", "blank": "\n \n\n", "borders": "\n\n\na b\n\n\n\n \n\nc\n\t\n d \n\n\ne\n\nf\n\ng\n\nh i", "big": "\n\n".join(words(150) if k % 9 == 0 else words(3) for k in range(200))}
    out |= {"exact": "\n\n".join([" ".join(["w"] * 50)] * 13), "empty": ""}
    return out


@pytest.mark.parametrize("cut, only", [(16, ("borders", "one", "empty")), (200, ("exact", "g1", "f3", "borders")), (5000, ()), (1 << 27, ())])
def test_files_cut_at_any_offset(spark, tmp_path, cut, only):
    for name, text in files().items():
        (tmp_path / f"{name}.txt").write_text(text)
    settings = {"spark.sql.files.maxPartitionBytes": str(cut), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    names = [n for n in files() if not only or n in only]
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        lines = text_lines(spark, [f"{tmp_path}/{n}.txt" for n in names])
        assert cut > 5000 or lines.select("split").distinct().count() > 3
        got = split_lines(lines).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    texts = spark.createDataFrame([(n, t) for n, t in files().items() if n in names], "name string, text string")
    want = texts.select("name", F.posexplode(corpus.split_documents(F.col("text"))).alias("pos", "doc")).collect()
    # A whole text of more than one line keeps its line ends, but for the last one.
    assert {(r["file"].rsplit("/", 1)[1][:-4], r["pos"], r["doc"].rstrip("\n")) for r in got} == {(r["name"], r["pos"], r["doc"].rstrip("\n")) for r in want}
    assert len(got) == len(want)


def test_states_of_the_chunker_compose():
    rng = np.random.default_rng(2)
    words = rng.integers(1, 150, 500)
    whole = walk(words, np.arange(200), 200)
    state, done = walk(words[:123], np.arange(200), 200)
    later, more = walk(words[123:], state, 200)
    assert (later == whole[0]).all() and (done + more == whole[1]).all()


def test_lines_may_be_cleaned(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("ISA\r\n\r\nDALAWA \xff".encode("latin-1"))
    lines = text_lines(spark, str(tmp_path / "a.txt"))
    got = split_lines(lines, clean=lambda c: F.lower(F.regexp_replace(c, "\r$", ""))).collect()
    assert [(r["pos"], r["doc"]) for r in got] == [(0, "isa\n\ndalawa �")]
    assert split_lines(lines.limit(0)).count() == 0 and big_files.split_lines is split_lines


def test_web_corpus_by_its_configuration(spark, tmp_path):
    """First published, then appended to twice; card and counts come without the target."""
    word = lambda k: " ".join([f"salita{k}"] * 40)
    put = lambda name, texts: spark.createDataFrame([("train", t) for t in texts], "split string, content string").write.parquet(str(tmp_path / name))
    put("a", [word(1), word(2), "maikli"])
    put("b", [word(2), word(3)])
    run = lambda name, append: tuple(pipelines.run_web(spark, pipelines.WebConfig(str(tmp_path / name), str(tmp_path / "t"), "hub/web-fil", append, wait=0)).first())
    assert run("a", True) == (2, 2, 0) and run("b", True) == (2, 1, 1) and run("b", True) == (2, 0, 2)
    config = pipelines.WebConfig("", str(tmp_path / "t"), "hub/web-fil")
    rows = spark.read.parquet(str(tmp_path / "t"))
    assert rows.count() == 3 and pipelines.web_card(spark, config) == stats.render_card(rows, "web-fil", "fil")
    assert "| **Total** | **3** | **120** |" in pipelines.web_card(spark, config)
    assert run("a", False) == (2, 2, 0) and "| Documents | 2 |" in pipelines.web_card(spark, config)


def test_books_by_their_configuration(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(20):
        (tmp_path / f"in/{k}.txt").write_text(f"b{k} " + "salita " * 60)
    config = pipelines.BookConfig((readers.FileSource(str(tmp_path / "in"), "*.txt", "aklat", "fil"),), str(tmp_path / "out"), tenths=8)
    assert {(r["split"], r["count"]) for r in pipelines.run_books(spark, config).groupBy("split").count().collect()} == {("train", 16), ("test", 4)}
    assert readers.jsonl_splits(spark, {s: str(tmp_path / f"out/split={s}") for s in ("train", "test")}, "id string, token_count int").count() == 20


def test_static_card(spark):
    card = Card("Name: of a set", "Some text.", ("fil", "no"), ("text-generation",), ("a b",), "cc-by-4.0", {"text": "The text."}, {"Usage": "Read it."}, "@article{x}")
    text = card.render(spark.createDataFrame([], "text string, n int, parts array<string>, audio struct<bytes:binary>").schema)
    assert text.startswith('---\nlanguage:\n- fil\n- "no"\ntask_categories:\n- text-generation\ntags:\n- "a b"\nlicense: cc-by-4.0\n---\n\n# Name: of a set\n\nSome text.\n\n## Schema\n')
    assert "| `text` | `string` | The text. |" in text and "| `parts` | `list[string]` |  |" in text and text.endswith("## Usage\n\nRead it.\n\n## Citation\n\n```\n@article{x}\n```\n")
    with pytest.raises(ValueError):
        Card("x", "y", (), (), columns={"absent": "?"}).render(spark.range(1).schema)
