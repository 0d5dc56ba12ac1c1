"""Deduplication against a target, and incremental append."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from weft.functions.text import content_hash
from weft.operators.corpus import first_wins


def target_hashes(target: DataFrame) -> DataFrame:
    """Distinct hashes of a target, from its column or, where that is null or absent, from its text. Texts
    are read only of rows without a hash: files whose statistics show no null are skipped."""
    own = content_hash(F.col("text")).alias("_hash")
    if "content_hash" not in target.columns:
        return target.select(own).distinct()
    known = target.filter("content_hash is not null").select(F.col("content_hash").alias("_hash"))
    if "text" not in target.columns:
        return known.distinct()
    return known.unionByName(target.filter("content_hash is null").select(own)).distinct()


def dedup_against(df: DataFrame, target: DataFrame | None, within: bool = False) -> DataFrame:
    """Rows of df whose text is not in the target (D1); the incoming text is hashed anew. Copies inside df
    stay unless `within`, which keeps the first in the order of the input. No target: df as it is."""
    if within:
        df = first_wins(df.withColumn("_order", F.monotonically_increasing_id()), content_hash(F.col("text")), "_order").drop("_order")
    if target is None:
        return df
    return df.join(target_hashes(target), content_hash(F.col("text")) == F.col("_hash"), "left_anti")


def append_to(df: DataFrame, target: DataFrame | None, within: bool = False) -> DataFrame:
    """Target rows and the new rows of df, by column name; absent columns are null (U1). Splits are rows of
    a `split` column, so those on one side only pass through."""
    new = dedup_against(df, target, within)
    return new if target is None else target.unionByName(new, allowMissingColumns=True)


def removal_counts(df: DataFrame, target: DataFrame | None) -> DataFrame:
    """before, after and removed per split."""
    marked = df.withColumn("_new", F.lit(1)) if target is None else df.join(target_hashes(target), content_hash(F.col("text")) == F.col("_hash"), "left").withColumn("_new", F.col("_hash").isNull().cast("int"))
    return marked.groupBy("split").agg(F.count("*").alias("before"), F.sum("_new").alias("after")).withColumn("removed", F.col("before") - F.col("after"))


@dataclass(frozen=True)
class Observed:
    """What a job that used `rows` saw on both sides of the deduplication: before, after and removed by split."""

    rows: DataFrame
    splits: list[str | None]
    before: Observation
    after: Observation

    def counts(self) -> DataFrame:
        """To be asked when the job has ended; it starts none."""
        before, after = self.before.get, self.after.get
        found = [(s, before[f"s{k}"], after[f"s{k}"]) for k, s in enumerate(self.splits)]
        return self.rows.sparkSession.createDataFrame([(s, b, a, b - a) for s, b, a in found if b], "split string, before long, after long, removed long")


def dedup_observed(df: DataFrame, target: DataFrame | None, splits: list[str | None], within: bool = False) -> Observed:
    """dedup_against with counts for each of the named splits, taken on the way by the job that writes or
    reads `rows` (A7): the target is scanned once, and nothing is joined or counted a second time. Spark counts
    a task again if its shuffle output is lost and made anew; removal_counts is exact then too."""
    counts: list[Column] = [F.count_if(F.col("split").eqNullSafe(F.lit(s))).alias(f"s{k}") for k, s in enumerate(splits)]
    before, after = Observation(), Observation()
    rows = dedup_against(df.observe(before, *counts), target, within).observe(after, *counts)
    return Observed(rows, splits, before, after)
