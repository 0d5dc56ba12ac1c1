"""Intermediate tables in the shared folder, and the spreading of small inputs."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MADE: dict[str, tuple[object, object]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, the warehouse, which all executors share too."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.sparkContext.master.startswith("local") and (":" not in warehouse or warehouse.startswith("file:")):
        raise ValueError("on a cluster, set spark.checkpoint.dir to a folder that all executors share")
    return warehouse + "/weft-staged"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder. What is below it goes when the program ends, or by drop()."""
    path = f"{shared_dir(spark)}/weft-{name}-{uuid.uuid4().hex}"
    if not _MADE:
        atexit.register(_clear)
    _MADE[path] = (spark._jvm.org.apache.hadoop.fs.Path(path), spark._jsc.hadoopConfiguration())
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: later stages start from files that survive
    a lost executor, and what came before is computed once."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._weft_path = path
    return out


def drop(*tables: DataFrame | None) -> None:
    """Delete staged tables that nothing will read again."""
    for t in tables:
        _delete(getattr(t, "_weft_path", None))


def _delete(path: str | None) -> None:
    if path in _MADE:
        at, conf = _MADE.pop(path)
        try:
            at.getFileSystem(conf).delete(at, True)
        except Exception:  # the JVM is gone: nothing is left to ask
            return


def _clear() -> None:
    for path in list(_MADE):
        _delete(path)


def spread(df: DataFrame) -> DataFrame:
    """df dealt over all cores where its files give fewer tasks than there are cores, and as it is
    otherwise: a large table is never shuffled for it."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are computed a single time for each row, however many filters and projections
    follow: the optimizer does not look behind the generator."""
    made = F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.inline_outer(made))
