"""Corpus operators, DataFrame -> DataFrame, for ``df.transform``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.functions import text as T
from weft.session import ship
from weft.staging import once, spread, staged


def text_column(df: DataFrame) -> DataFrame:
    """The first column named text or content becomes text."""
    name = next((c for c in df.columns if c in ("text", "content")), None)
    if name is None:
        raise ValueError(f"no text or content column among {df.columns}")
    return df.withColumnRenamed(name, "text")


def clean_web(df: DataFrame, min_words: int = 30, min_latin_ratio: float = 0.4) -> DataFrame:
    """text_cleaned beside text, unusable rows gone."""
    ship(df.sparkSession)
    cleaned = once(spread(text_column(df)), text_cleaned=T.clean_text(F.col("text")))
    return cleaned.filter(T.is_usable(F.col("text_cleaned"), min_words, min_latin_ratio))


def use_cleaned(df: DataFrame) -> DataFrame:
    """text_cleaned takes the place of text."""
    return df.withColumn("text", F.col("text_cleaned")).drop("text_cleaned")


def name_labels(repo: str) -> tuple[str, str]:
    """(source, language) of a data set's name: its last part after / and after -."""
    return repo.split("/")[-1], repo.split("-")[-1]


def name_label_columns(repo: Column) -> tuple[Column, Column]:
    """name_labels of a column of names."""
    last = lambda by: F.element_at(F.split(repo, by), -1)
    return last("/"), last("-")


def add_columns(df: DataFrame, source: str | Column, language: str | Column) -> DataFrame:
    """source, language, token_count and content_hash (P5). A null text has 0 words."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return df.withColumns({"source": lit(source), "language": lit(language), "token_count": T.word_count(F.col("text")), "content_hash": T.content_hash(F.col("text"))})


def record_id(source: Column, file: Column, index: Column) -> Column:
    """{source}_{index, six digits}_{first 8 of md5(source:file:index)}."""
    return F.format_string("%s_%06d_%s", source, index, F.left(F.md5(F.concat_ws(":", source, file, index.cast("string"))), F.lit(8)))


def split_documents(c: Column, target_words: int = 200, short_words: int = 80, few: int = 5) -> Column:
    """Array of a file's documents (X1, X2): paragraphs, or lines if there is one paragraph; if these are
    more than `few` and short on average they are gathered until `target_words`, else the text is one."""
    solid = lambda a: F.filter(F.transform(a, T.strip), lambda x: x != "")
    paragraphs = solid(F.split(c, "\n{2,}", -1))
    # Bound as lambda variables, so that paragraphs and pieces are made once.
    pieces = F.transform(F.array(paragraphs), lambda a: F.when(F.size(a) == 1, solid(T.lines(c))).otherwise(a))[0]
    counted = F.transform(F.array(F.transform(pieces, lambda x: F.struct(x.alias("t"), T.word_count(x).alias("n")))), lambda p: _gathered(p, c, target_words, short_words, few))
    return counted[0]


def _gathered(p: Column, whole: Column, target: int, short: int, few: int) -> Column:
    total = F.aggregate(p, F.lit(0), lambda a, x: a + x["n"])
    empty = F.array().cast("array<string>")
    start = F.struct(empty.alias("docs"), empty.alias("buf"), F.lit(0).alias("n"))

    def step(a: Column, x: Column) -> Column:
        buf, n = F.concat(a["buf"], F.array(x["t"])), a["n"] + x["n"]
        full = n >= target
        return F.struct(F.when(full, F.concat(a["docs"], F.array(F.array_join(buf, "\n")))).otherwise(a["docs"]).alias("docs"), F.when(full, empty).otherwise(buf).alias("buf"), F.when(full, 0).otherwise(n).alias("n"))

    chunks = F.aggregate(p, start, step, lambda a: F.when(F.size(a["buf"]) > 0, F.concat(a["docs"], F.array(F.array_join(a["buf"], "\n")))).otherwise(a["docs"]))
    return F.when(F.size(p) == 0, empty).when((total / F.size(p) < short) & (F.size(p) > few), chunks).otherwise(F.array(whole))


def first_wins(df: DataFrame, key: Column, *order: str) -> DataFrame:
    """Of rows with equal keys, the first by `order` (D2). Spark drops all but a task's first row of a key
    before the shuffle, so a key that a third of the rows share is no hot spot; columns that are not asked
    for later, such as the text that was hashed, are not shuffled."""
    place = F.row_number().over(Window.partitionBy("_key").orderBy(*order))
    return df.withColumn("_key", key).withColumn("_place", place).filter("_place = 1").drop("_key", "_place")


def running_index(df: DataFrame, source: str, file: str, position: str, name: str = "doc_idx") -> DataFrame:
    """Index of a row within its source by (file, position), from 0 (D3), by prefix sums on two levels. Rows are
    cut into ranges of (source, file, position) and sorted within them, once, into a staged table; a row's
    offset in its range, less that of its source's first row there, plus the source's rows in ranges before is
    its index. The sums run over the ranges' totals alone, as many rows as there are ranges and sources
    together, so the size of a source burdens no task, however few files or many documents it has. Null sources are
    one source and null files one file, the first."""
    keys = [F.col(f"`{c}`") for c in (source, file, position)]
    # The identifiers count up within a partition, from its number times 2 ** 33.
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed = staged(ranged, "ranges").withColumn("_range", F.shiftright("_at", 33))
    shifts = range_shifts(placed, F.col(f"`{source}`"))
    same = (F.col("_range") == F.col("_of")) & F.col(f"`{source}`").eqNullSafe(F.col("_source"))
    return placed.join(shifts, same).withColumn(name, F.col("_at") - F.col("_first") + F.col("_before")).select(*[f"`{c}`" for c in df.columns], name)


def range_shifts(placed: DataFrame, source: Column) -> DataFrame:
    """(_of, _source, _first, _before): of every range and source the first _at and the source's rows in the
    ranges before. Totals are summed within the ranges before they are shuffled."""
    totals = placed.groupBy(F.col("_range").alias("_of"), source.alias("_source")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_source").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1))
    return totals.select("_of", "_source", "_first", F.coalesce(before, F.lit(0)).alias("_before"))


def exploded(df: DataFrame, array: Column, pos: str, value: str) -> DataFrame:
    """df with a row for each element. The optimizer puts a filter on the size of what posexplode() takes, which
    makes the array anew; it does not for the outer form."""
    return df.select("*", F.posexplode_outer(array).alias(pos, value)).filter(F.col(pos).isNotNull())


def file_documents(files: DataFrame, min_words: int = 50, min_latin_ratio: float = 0.4) -> DataFrame:
    """Documents of files (source_ord, source, language, name, text): cleaned, split, filtered, first-wins
    deduplicated: source_ord, source, language, name, pos, text, token_count."""
    ship(files.sparkSession)
    cleaned = once(spread(files), text=T.clean_corpus(F.col("text"), F.col("language")))
    docs = exploded(cleaned, split_documents(F.col("text")), "pos", "doc").select("source_ord", "source", "language", "name", "pos", F.col("doc").alias("text"))
    good = once(docs, token_count=T.word_count(F.col("text"))).filter((F.col("token_count") >= min_words) & (T.latin_ratio(F.col("text")) >= min_latin_ratio))
    return first_wins(good, T.content_hash(F.col("text")), "source_ord", "name", "pos")


def file_corpus(files: DataFrame, min_words: int = 50, min_latin_ratio: float = 0.4) -> DataFrame:
    """Records of files, entry B: file_documents, numbered: text, id, source, language, token_count."""
    return running_index(file_documents(files, min_words, min_latin_ratio), "source_ord", "name", "pos").select("text", record_id(F.col("source"), F.col("name"), F.col("doc_idx")).alias("id"), "source", "language", "token_count")
