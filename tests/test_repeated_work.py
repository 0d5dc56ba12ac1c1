"""Plans of the cleaning queries hold costly expressions no more often than they are needed."""

import pytest

from pyspark.sql import functions as F

from weft.functions import text as T
from weft.operators import big_files, corpus
from weft.plans import io_queries, registry

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["P1_P2_P4_web_corpus", "T1_P3_clean_text_pages"])
def test_lines_of_a_text_are_cut_once(spark, name):
    """Once for texts that go to Python, once for all others."""
    assert plan(registry.QUERIES[name](spark, SF)).count("Report Abuse") == 2


def test_strip_by_listed_characters(spark):
    spaces = [chr(i) for i in range(0x3100) if chr(i).isspace()]
    rows = [(f"{s}a{s}b{s}{s}",) for s in spaces] + [("".join(spaces),), ("",), (None,), ("é​",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(T.strip("t")).collect()]
    assert got == [t if t is None else t.strip() for (t,) in rows]


def test_files_are_split_once_and_not_shuffled_for_their_source(spark):
    files = registry.corpus_files(spark, SF)
    assert "strategy=broadcast" in plan(files)
    split = plan(corpus.file_documents(files))
    assert "size(transform(" not in "".join(line for line in split.split("\n") if "Filter" in line)
    assert "Generate posexplode" in split and ", true, [pos#" in split


def test_file_counts_need_no_numbers(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("records are numbered")

    monkeypatch.setattr(corpus, "running_index", refuse)
    assert registry.QUERIES["A5_files_by_source"](spark, SF).count() > 0


def test_ranges_grow_in_number_with_the_input(spark, monkeypatch):
    """A row of 64 MB of texts more is a range more, not a larger range."""
    texts = spark.range(6).select(F.col("id").alias("doc_id"), F.expr("repeat('ab ', 1 << 24)").alias("text"))
    monkeypatch.setattr(io_queries, "docs", lambda *_: texts)
    assert plan(registry.QUERIES["D1_within_first"](spark, SF)).count("RepartitionByExpression") == 1
    assert "], 5" in plan(registry.QUERIES["D1_within_first"](spark, SF))


def test_lines_are_numbered_without_their_texts(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n\ntwo\nthree\n")
    rows = big_files.text_lines(spark, str(tmp_path)).select("file", "split", "at", (F.col("line") == "").alias("blank"))
    assert [r["paragraph"] for r in big_files._paragraphs(rows, ["file"]).orderBy("at").collect()] == [0, 0, 1, 1]
