"""A corpus pipeline over `documents`: language ID, near duplicates, benchmark decontamination, secret
redaction, packing. Counted as part of the subpackage ``weft.llm``.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; its result is written as
Parquet and read again as the next one's docs. All but the last return the columns of `documents`. Further
columns of the input, whatever their names, are set aside in a stage and stand in its result as they were.
SQL can express neither the language model nor the tokenizer, so ORACLE_SQL is None and
tests/llm/test_pipeline.py holds the result against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import decontam, jaccard, langid, packing, secrets
from weft.llm.common import drop, spread, staged, table
from weft.llm.queries import langid_held_out, word_tokenizer


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: The columns that stages work on.
DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")
#: What a document needs to count as identified: a learned language that is likelier than all others together,
#: and some share of words that the model has seen in training.
MIN_SCORE, MIN_KNOWN = 0.5, 0.1


def with_own_columns(stage: Stage) -> Stage:
    """A stage that works on DOCUMENTS, over tables with other columns too: those go by private names in it."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: c if c in DOCUMENTS else f"_own_{k}" for k, c in enumerate(docs.columns)}
        out = stage(spark, docs.select(*[F.col(f"`{c}`").alias(to) for c, to in names.items()]), sf_dir)
        return out.select(*[F.col(to).alias(c) for c, to in names.items()])

    return run


@with_own_columns
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay. Those go that have no letters, whose score is under MIN_SCORE, or of
    whose words less than MIN_KNOWN are known, as text in a language that was not learned and strings of random
    letters. The model learns from the rows that op7 may learn from."""
    model = langid.train(docs.filter(~langid_held_out()))
    named = langid.identify(spread(docs), model, docs.columns)
    return named.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SCORE) & (F.col("known") >= MIN_KNOWN)).select(*docs.columns)


@with_own_columns
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by sets of five-word shingles at a similarity of 0.8 or more, the one with the
    smallest id stays. Rows that share an id stay or go together, and one of those with equal texts stays;
    documents without an id stay."""
    found = jaccard.components(docs, n=5, percent=80)
    gone = staged(found.filter("doc_id <> component_id").select("doc_id").distinct(), "duplicates")
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    repeated = staged(docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*docs.columns)
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(once)


@with_own_columns
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


@with_own_columns
def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mask, and n_chars follows the text; no document goes."""
    scanned = secrets.scan(docs, secrets.train(secrets.labelled_samples(docs)))
    marked = scanned.withColumn("_changed", F.size("secret_spans") > 0)
    return secrets.redact(marked).withColumn("n_chars", F.when(F.col("_changed"), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    packed = packing.pack(docs, ["doc_id"], word_tokenizer())
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secret_redaction),
    ("packing", sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        made = staged(stage(spark, docs, sf_dir), name)
        drop(docs)  # what the stage before wrote; the table itself is no staged one
        docs = made
    return STAGES[-1][1](spark, docs, sf_dir)
