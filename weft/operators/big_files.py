"""Documents of text files of any size (S7, X1, X2): the rules of corpus.split_documents, without a file as one value.

Files are read by lines, in splits. A line's place is that of its split in the file and its own in the split,
so no line is numbered by anything that runs over a whole file. Whether a line begins a paragraph
depends on the line before it; between splits that is settled by one row a split. Numbers and words of a file's pieces
decide how it is split before any text is put together.

The chunker (gather pieces until `target_words`, then begin anew) is a machine whose state is the number of words
gathered, below `target_words`. A split's pieces lead each state to another and complete some documents on the
way: a table of target_words entries. The tables are followed from split to split, and every split then
numbers the documents of its own pieces from the state that it begins with.

Defined results: a file without a word gives no documents; the end of the last line is no part of the text; bad
UTF-8 becomes U+FFFD; a file that stays one document must fit into one value, as any document.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.functions import text as T
from weft.session import ship
from weft.staging import staged


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, split, at, line) and the partition columns of the text files at a path: `at` counts up with the
    lines of a split, splits are named by the byte that they begin at. Large files are read by many tasks."""
    lines = spark.read.option("lineSep", "\n").text(path)
    more = [c for c in lines.columns if c != "value"]
    return lines.select(*more, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"), F.make_valid_utf8("value").alias("line"))


def split_lines(lines: DataFrame, keys: list[str] | None = None, clean: Callable[[Column], Column] | None = None, target_words: int = 200, short_words: int = 80, few: int = 5) -> DataFrame:
    """(keys, pos, doc) of the documents of files given by text_lines; keys (by default file) name a file.
    `clean` is applied to every line first."""
    ship(lines.sparkSession)
    keys = keys or ["file"]
    at = ["split", "at"]
    body = clean(F.col("line")) if clean else F.col("line")
    rows = staged(lines.select(*keys, *at, body.alias("line")).withColumns({"words": T.word_count(F.col("line")), "blank": F.col("line") == ""}), "lines")
    # Lines are numbered twice: without their texts to count words, with them to put paragraphs together.
    paragraphs = _paragraphs(rows.drop("line"), keys).filter("not blank").groupBy(*keys, "paragraph").agg(F.sum("words").cast("long").alias("words"), F.min(F.struct(*at)).alias("first")).filter("words > 0")
    files = staged(paragraphs.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("words").alias("words")), "files")
    one = files.filter("n = 1").select(*keys)
    # Files of one paragraph: their lines, by all line ends, are the pieces.
    parts = rows.join(one, keys, "left_semi").select(*keys, *at, F.posexplode(T.lines(F.col("line"))).alias("sub", "piece"))
    by_line = staged(parts.select(*keys, *at, "sub", T.strip(F.col("piece")).alias("piece")).filter("piece <> ''").withColumn("words", T.word_count(F.col("piece")).cast("long")), "pieces")
    sums = by_line.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("words").alias("words")).unionByName(files.filter("n > 1"))
    chunked = staged(sums.filter((F.col("words") / F.col("n") < short_words) & (F.col("n") > few)).select(*keys), "chunked")
    whole = _joined(rows.join(files, keys, "left_semi").join(chunked, keys, "left_anti"), keys, at, "line").select(*keys, F.lit(0).alias("pos"), "text")
    pieces = by_line.select(*keys, *at, "sub", "words").unionByName(paragraphs.join(one, keys, "left_anti").select(*keys, "first.*", F.lit(0).alias("sub"), "words"))
    placed = staged(_chunks(pieces.join(chunked, keys, "left_semi"), keys, target_words), "chunks")
    # A paragraph's text is put together by its number, which its first line gives.
    texts = _joined(_paragraphs(rows, keys).filter("not blank").join(chunked, keys, "left_semi").join(one, keys, "left_anti"), [*keys, "paragraph"], at, "line", first=True)
    texts = texts.select(*keys, "first.*", F.lit(0).alias("sub"), T.strip(F.col("text")).alias("piece")).unionByName(by_line.select(*keys, *at, "sub", "piece"))
    docs = _joined(placed.join(texts, [*keys, *at, "sub"]), [*keys, "pos"], [*at, "sub"], "piece")
    return docs.select(*keys, "pos", F.col("text").alias("doc")).unionByName(whole.withColumnRenamed("text", "doc"))


def _joined(rows: DataFrame, keys: list[str], at: list[str], text: str, first: bool = False) -> DataFrame:
    """(keys, text) of texts joined by line ends in their order, with the least place if asked for."""
    held = F.array_sort(F.collect_list(F.struct(*at, text)))
    more = [F.min(F.struct(*at)).alias("first")] if first else []
    return rows.groupBy(*keys).agg(held.alias("held"), *more).select(*keys, F.array_join(F.transform("held", lambda x: x[text]), "\n").alias("text"), *(["first"] if first else []))


def _paragraphs(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows (keys, split, at, blank) with the number of their paragraph in the file: lines that are not empty, after an empty one, begin
    one. Windows run within a split; from split to split go a row's worth of counts."""
    here = Window.partitionBy(*keys, "split").orderBy("at")
    begins = ~F.col("blank") & F.coalesce(F.lag("blank").over(here), F.lit(False))
    own = rows.withColumn("begins", begins.cast("int"))
    ends = lambda f: f(F.struct("at", "blank"))["blank"]
    splits = own.groupBy(*keys, "split").agg(F.sum("begins").alias("begun"), ends(F.min).alias("empty_first"), ends(F.max).alias("empty_last"))
    over = Window.partitionBy(*keys).orderBy("split")
    # The first line of a split begins a paragraph too if the split before it ended in an empty line.
    splits = splits.withColumn("seam", (~F.col("empty_first") & F.coalesce(F.lag("empty_last").over(over), F.lit(False))).cast("int"))
    splits = splits.withColumn("before", F.coalesce(F.sum(F.col("begun") + F.col("seam")).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("seam"))
    found = own.join(splits.select(*keys, "split", "before"), [*keys, "split"])
    return found.withColumn("paragraph", F.col("before") + F.sum("begins").over(here.rowsBetween(Window.unboundedPreceding, 0)))


def walk(words: np.ndarray, state: np.ndarray, target: int) -> tuple[np.ndarray, np.ndarray]:
    """States and completed documents after pieces of so many words, from each of some states."""
    state, done = state.astype(np.int64).copy(), np.zeros(len(state), np.int64)
    for w in words.tolist():
        state += w
        full = state >= target
        done += full
        state[full] = 0
    return state, done


def _chunks(pieces: DataFrame, keys: list[str], target: int) -> DataFrame:
    """(keys, split, at, sub, pos) of pieces (keys, split, at, sub, words)."""
    names = [f"k{i}" for i in range(len(keys))]
    named = staged(pieces.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "split", "at", "sub", "words"), "words")
    kinds = ", ".join(f"{n} {named.schema[n].dataType.simpleString()}" for n in names)

    def table(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["at", "sub"])
        state, done = walk(pdf["words"].to_numpy(), np.arange(target), target)
        return pdf.iloc[:1][[*names, "split"]].assign(state=[state.tolist()], done=[done.tolist()])

    def follow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, at, pos, begin = pdf.sort_values("split"), 0, 0, []
        for state, done in zip(pdf["state"], pdf["done"]):
            begin.append((at, pos))
            at, pos = state[at], pos + done[at]
        return pdf[[*names, "split"]].assign(state=[a for a, _ in begin], pos=[p for _, p in begin])

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["at", "sub"])
        gathered, pos, out = int(pdf["state"].iloc[0]), int(pdf["first"].iloc[0]), []
        for w in pdf["words"].tolist():
            out.append(pos)
            gathered += w
            if gathered >= target:
                gathered, pos = 0, pos + 1
        return pdf[[*names, "split", "at", "sub"]].assign(pos=out)

    by_split = [*names, "split"]
    tables = named.groupBy(*by_split).applyInPandas(table, f"{kinds}, split long, state array<long>, done array<long>")
    begins = staged(tables.groupBy(*names).applyInPandas(follow, f"{kinds}, split long, state long, pos long"), "begins").withColumnRenamed("pos", "first")
    placed = named.join(begins, by_split).groupBy(*by_split).applyInPandas(number, f"{kinds}, split long, at long, sub int, pos int")
    return placed.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], "split", "at", "sub", "pos")
