"""Incremental append to a Parquet table with a hash index beside it.

An append first stages its new rows below the index, writes them to the table, and then adds their hashes to the
index. If it stops in between, the next one finds the staged rows and ends its work before its own: rows of
them that the table has already, counted by hash, are not written again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.functions.text import content_hash
from weft.operators.corpus import first_wins
from weft.sources.hash_index import HashIndex
from weft.sources.readers import exists
from weft.sources.writers import _filesystem, _renamed
from weft.staging import drop, staged


class IndexedTable:
    """The Parquet table at `path`, and its index at `index` (by default beside it). `then` is called with the new
    rows and a name of each append after they are written; it may be called again with the same name."""

    def __init__(self, spark: SparkSession, path: str, index: str | None = None, digits: int | None = None, merge_at: int = 8, then: Callable[[DataFrame, str], None] | None = None):
        self.spark, self.path, self.then = spark, path.rstrip("/"), then
        self.index = HashIndex(spark, index or self.path + ".hashes", digits, merge_at)
        self.pending = self.index.path + ".pending"

    def rows(self) -> DataFrame | None:
        return self.spark.read.option("mergeSchema", "true").parquet(self.path) if exists(self.spark, self.path) else None

    def append(self, df: DataFrame, within: bool = False) -> DataFrame:
        """Add the rows of df whose text the table does not have; copies inside df stay unless `within`. Returns
        (rows, added, removed), one row. Only the index is read, and of it the buckets of df's hashes; a lost
        index is made from the table first."""
        self.recover()
        if not self.index.whole():
            self.index.rebuild(self.rows())
        if within:
            df = first_wins(df.withColumn("_order", F.monotonically_increasing_id()), content_hash(F.col("text")), "_order").drop("_order")
        batch = staged(df.withColumn("_hash", content_hash(F.col("text"))), "batch")
        seen = self.index.seen(batch.select(F.col("_hash").alias("hash")))
        fs, ready = _filesystem(self.spark, self.pending)
        fs.delete(_filesystem(self.spark, self.pending + ".writing")[1], True)
        fresh = batch.join(seen.withColumnRenamed("hash", "_hash"), "_hash", "left_anti").withColumn("_append", F.lit(uuid.uuid4().hex))
        fresh.write.parquet(self.pending + ".writing")
        _renamed(fs, _filesystem(self.spark, self.pending + ".writing")[1], ready)
        new = self.spark.read.schema(fresh.schema).parquet(self.pending)
        counted = self.spark.createDataFrame([(batch.count(), new.count())], "rows long, added long").withColumn("removed", F.col("rows") - F.col("added"))
        self._write(new)
        self._settle(new)
        drop(batch)
        return counted

    def _write(self, new: DataFrame) -> None:
        new.drop("_hash", "_append").write.mode("append").parquet(self.path)

    def _settle(self, new: DataFrame, indexed: bool = False) -> None:
        """What follows the rows is done, their hashes join the index, and the staged rows go."""
        one = new.select("_append").first()
        if one and self.then:
            self.then(new.drop("_hash", "_append"), one["_append"])
        if one and not indexed:
            self.index.add(new.select(F.col("_hash").alias("hash")))
        fs, ready = _filesystem(self.spark, self.pending)
        fs.delete(ready, True)

    def recover(self) -> None:
        """End an append that stopped after its rows were staged. None of their hashes was in the table before
        it, so as many of a hash as the table has now are written."""
        if not exists(self.spark, self.pending):
            return
        new, target = self.spark.read.parquet(self.pending), self.rows()
        if target is not None:
            held = target.withColumn("_hash", content_hash(F.col("text"))).join(new.select("_hash").distinct(), "_hash", "left_semi").groupBy("_hash").agg(F.count("*").alias("_held"))
            placed = new.withColumn("_place", F.row_number().over(Window.partitionBy("_hash").orderBy(F.lit(0))))
            left = staged(placed.join(held, "_hash", "left").filter(F.col("_place") > F.coalesce("_held", F.lit(0))).select(*new.columns), "left")
        else:
            left = new
        self._write(left)
        lost = not self.index.whole()
        if lost:
            self.index.rebuild(self.rows())
        self._settle(new, indexed=lost)
