"""What the operators of this subpackage share: staged tables, widths of shuffles, text access."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.staging import drop, scratch, shared_dir, spread, staged

__all__ = ["drop", "input_width", "scratch", "shared_dir", "shuffle_width", "spread", "staged", "table", "text_or_empty"]


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: Partitions of a shuffle, at most.
MOST_PARTITIONS = 100_000


def input_width(df: DataFrame, text: str = "text", bytes_each: int = 128 << 20) -> int:
    """Partitions for a shuffle of df's rows: one for each `bytes_each` bytes of their texts, which are counted,
    and the session's number at least. Estimates of the optimizer say nothing about made rows and joins."""
    size = df.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
    return min(MOST_PARTITIONS, max(shuffle_width(df.sparkSession), -(-size // bytes_each)))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
