"""Reproducible train/test splits and shards.

Rows are in the order of md5(seed:id), ties by id. How many rows begin with each few digits of the hash is
counted in one scan of the ids; from these counts follow the number of rows, the place of every range of hashes,
and the range that holds a cut.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Digits of a hash that one round of counting tells apart: at most 16 ** DIGITS rows reach the driver.
DIGITS = 4
#: Rows of the range with the cut whose hashes are compared one by one; larger ranges are counted again.
FEW = 4096


def order_hash(id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))))


@dataclass(frozen=True)
class Histogram:
    """Numbers of rows by the hash digits that follow `start`: prefixes in order, and rows before each."""

    start: str
    prefixes: list[str]
    before: list[int]
    rows: int

    def holding(self, place: int) -> tuple[str, int, int]:
        """(prefix, rows before it, rows in it) of the range with the row at a place."""
        k = bisect_right(self.before, place) - 1
        return self.prefixes[k], self.before[k], (self.before[k + 1] if k + 1 < len(self.before) else self.rows) - self.before[k]


def histogram(df: DataFrame, id: Column, seed: int = 42, start: str = "") -> Histogram:
    """One scan of the ids; counts are summed before the shuffle."""
    h = order_hash(id, seed)
    counted = df.select(h.alias("h")).filter(F.startswith("h", F.lit(start))).groupBy(F.left("h", F.lit(len(start) + DIGITS)).alias("p")).count().collect()
    found = sorted((r["p"], r["count"]) for r in counted)
    sums = list(accumulate((n for _, n in found), initial=0))
    return Histogram(start, [p for p, _ in found], sums[:-1], sums[-1])


@dataclass(frozen=True)
class Cut:
    """The first `place` rows of an order end within the rows of hash `md5` and id `id`, of which `own` come
    before and `of` are there; with `md5` None, all rows come before if `all`, else none."""

    place: int
    md5: str | None = None
    id: str | None = None
    own: int = 0
    of: int = 0
    all: bool = False


def select_cut(df: DataFrame, id: Column, place: int, counts: Histogram, seed: int = 42) -> Cut:
    """Where the first `place` rows end. The range of hashes that holds the last of them is counted again by more
    digits until few rows are left, or all have one hash; no row is shuffled or sorted but those few."""
    if place <= 0 or place >= counts.rows:
        return Cut(place, all=place > 0)
    prefix, before, rows = counts.holding(place - 1)
    while rows > FEW and len(prefix) < 32:
        finer = histogram(df, id, seed, prefix)
        prefix, more, rows = finer.holding(place - 1 - before)
        before += more
    # A row for each id: rows that share one are a number.
    text = F.coalesce(id.cast("string"), F.lit(""))
    last = df.select(order_hash(id, seed).alias("h"), text.alias("i")).filter(F.startswith("h", F.lit(prefix))).groupBy("h", "i").count().orderBy("h", "i")
    for r in last.toLocalIterator():
        if before + r["count"] >= place:
            return Cut(place, r["h"], r["i"], place - before, r["count"])
        before += r["count"]
    raise ValueError("the table changed while its ids were counted")


def mark_first(df: DataFrame, id: Column, cut: Cut, seed: int = 42, name: str = "first") -> DataFrame:
    """df with whether a row is among the first. Where the cut falls between rows that share an id, as many of
    them as are needed come before it, in the order of the input's partitions."""
    if cut.md5 is None:
        return df.withColumn(name, F.lit(cut.all))
    h, text = order_hash(id, seed), F.coalesce(id.cast("string"), F.lit(""))
    below = (h < cut.md5) | ((h == cut.md5) & (text < F.lit(cut.id)))
    same = (h == cut.md5) & (text == F.lit(cut.id))
    if cut.own == cut.of:
        return df.withColumn(name, below | same)
    # The identifiers are a column of their own: within a condition they would count some rows only.
    numbered = df.withColumn("_at", F.monotonically_increasing_id())
    return numbered.withColumn(name, below | (same & (F.col("_at") <= _last_of(numbered.filter(same), cut.own)))).drop("_at")


def _last_of(rows: DataFrame, own: int) -> int:
    """The identifier of the `own`th of some rows: its partition is found by counts, a row for each, and the row
    by its place there."""
    for r in rows.groupBy(F.shiftright("_at", 33).alias("part")).count().orderBy("part").collect():
        if own <= r["count"]:
            return rows.filter(F.shiftright("_at", 33) == r["part"]).select("_at").orderBy("_at").offset(own - 1).first()["_at"]
        own -= r["count"]
    raise ValueError("the table changed while its ids were counted")


def assign_split(df: DataFrame, id: Column, seed: int = 42, tenths: int = 9, counts: Histogram | None = None) -> DataFrame:
    """df with split: train for the first n * tenths div 10 rows of the order, else test (R1). Two scans of the
    ids find the cut; the rows themselves are only filtered through, in place."""
    counts = counts or histogram(df, id, seed)
    cut = select_cut(df, id, counts.rows * tenths // 10, counts, seed)
    return mark_first(df, id, cut, seed, "_first").withColumn("split", F.when(F.col("_first"), "train").otherwise("test")).drop("_first")


def shuffled_rank(df: DataFrame, id: Column, seed: int = 42, name: str = "rank", counts: Histogram | None = None) -> DataFrame:
    """Place of each row (from 0) in the order. Ranks are taken within the histogram's ranges and shifted by the
    rows before them: no task sorts more than a range."""
    counts = counts or histogram(df, id, seed)
    before = _table(df.sparkSession, counts)
    text = F.coalesce(id.cast("string"), F.lit(""))
    keyed = df.withColumn("_id", text).withColumn("_md5", order_hash(id, seed)).withColumn("_range", F.left("_md5", F.lit(DIGITS)))
    ranked = keyed.withColumn("_at", F.row_number().over(Window.partitionBy("_range").orderBy("_md5", "_id")) - 1)
    return ranked.join(F.broadcast(before), "_range").withColumn(name, F.col("_before") + F.col("_at")).select(*[f"`{c}`" for c in df.columns], name)


def _table(spark: SparkSession, counts: Histogram) -> DataFrame:
    """(_range, _before), at most 16 ** DIGITS rows."""
    return spark.createDataFrame(list(zip(counts.prefixes, counts.before)), "_range string, _before long")


def train_test(df: DataFrame, id: Column, seed: int = 42, tenths: int = 9, counts: Histogram | None = None) -> DataFrame:
    """df with rank and split, the split of assign_split."""
    counts = counts or histogram(df, id, seed)
    return shuffled_rank(df, id, seed, counts=counts).withColumn("split", F.when(F.col("rank") < counts.rows * tenths // 10, "train").otherwise("test"))


def shards(df: DataFrame, id: Column, seed: int = 42, tenths: int = 9, shard_rows: int = 2000) -> DataFrame:
    """train_test with shard (from 0 in each split) and shard_name {split}-{i}-of-{n}.parquet."""
    counts = histogram(df, id, seed)
    n, cut = counts.rows, counts.rows * tenths // 10
    split = train_test(df, id, seed, tenths, counts)
    at = F.when(F.col("split") == "train", F.col("rank")).otherwise(F.col("rank") - cut)
    of = F.when(F.col("split") == "train", F.lit(-(-cut // shard_rows))).otherwise(F.lit(-(-(n - cut) // shard_rows)))
    return split.withColumn("shard", F.floor(at / shard_rows).cast("int")).withColumn("shard_name", F.format_string("%s-%05d-of-%05d.parquet", "split", "shard", of))
