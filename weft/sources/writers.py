"""Sinks: JSONL, sharded Parquet with resume, audio folders, staged tables with retry."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.session import ship
from weft.sources.readers import PROGRESS, completed_shards, exists
from weft.sources.shard_sink import ShardSink

log = logging.getLogger("weft")


def with_retry(action: Callable[[], None], attempts: int = 5, wait: float = 30.0) -> None:
    """Run an action, again after a constant wait where it fails; the last failure is raised."""
    for k in range(1, attempts + 1):
        try:
            return action()
        except Exception:
            log.warning("attempt %d of %d failed", k, attempts, exc_info=True)
            if k == attempts:
                raise
            time.sleep(wait)


def write_jsonl(df: DataFrame, folder: str, columns: list[str] | None = None) -> None:
    """JSON lines below split=<name>, keys in column order (K1)."""
    out = df.select(*(columns or [c for c in df.columns if c != "split"]), "split")
    out.write.mode("overwrite").option("ignoreNullFields", "false").partitionBy("split").json(folder)


def _filesystem(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _renamed(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"{source} could not be renamed to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _filesystem(spark, path)
    fs.delete(at, True)


def swap(spark: SparkSession, path: str) -> None:
    """Put the table at `path`.staged in the place of the one at `path`. The old table is moved aside first and
    deleted last, so at every moment one of the two is there, and a swap that stopped anywhere is finished by
    another."""
    fs, target = _filesystem(spark, path)
    stage, old = (_filesystem(spark, path + end)[1] for end in (".staged", ".old"))
    if fs.exists(stage):
        if fs.exists(target):
            fs.delete(old, True)
            _renamed(fs, target, old)
        _renamed(fs, stage, target)
    fs.delete(old, True)


def replace_table(df: DataFrame, path: str) -> None:
    """Write beside the target, then swap (K4, K6, N12): a table can replace what it was read from."""
    publish(df, path, attempts=1)


def publish(df: DataFrame, path: str, attempts: int = 5, wait: float = 30.0) -> None:
    """replace_table with retries. The write is tried again only while the target is still in its place, and
    the swap by itself: what was written is never read from a target that has gone."""
    spark = df.sparkSession
    with_retry(lambda: df.write.mode("overwrite").parquet(path + ".staged"), attempts, wait)
    with_retry(lambda: swap(spark, path), attempts, wait)


def _moved(spark: SparkSession, pairs: list[tuple[object, str]]) -> None:
    """Rename files, many at a time."""

    def one(pair: tuple[object, str]) -> None:
        fs, target = _filesystem(spark, pair[1])
        fs.mkdirs(target.getParent())
        fs.delete(target, False)
        _renamed(fs, pair[0], target)

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(one, pairs))


def write_shards(df: DataFrame, folder: str, progress: str) -> DataFrame:
    """Write each (split, shard, shard_name) of df as one named Parquet file, leaving out shards that the
    progress log has (F13, R2, K2, K5). Tasks write, name and log the files (shard_sink). Returns (split,
    shard_idx, shard_name, rows) of what this run wrote, from its log."""
    spark = df.sparkSession
    ship(spark)
    spark.dataSource.register(ShardSink)
    done = completed_shards(spark, progress).select("split", F.col("shard_idx").alias("shard"))
    todo = df.join(done, ["split", "shard"], "left_anti").withColumn("shard", F.col("shard").cast("int"))
    run = uuid.uuid4().hex
    todo.repartition("split", "shard").sortWithinPartitions("split", "shard").write.format("weft_shards").options(path=folder, progress=progress, run=run).mode("append").save()
    if not exists(spark, progress):
        return spark.createDataFrame([], "split string, shard_idx int, shard_name string, rows long")
    return spark.read.schema(PROGRESS).json(progress).filter(F.col("run") == run).select("split", "shard_idx", "shard_name", "rows")


def publish_table(df: DataFrame, name: str, location: str, attempts: int = 5, wait: float = 30.0) -> None:
    """Publish to a table of the catalog (K4, K6): the rows go to a fresh folder below `location`, then the
    table is pointed at it, in one step of the catalog. A table can so replace what it was read from, queries that
    began before read on, and a write that fails changes nothing. The folder before goes with the next call."""
    spark = df.sparkSession
    before = table_location(spark, name)
    path = f"{location.rstrip('/')}/v-{uuid.uuid4().hex}"
    with_retry(lambda: df.write.mode("overwrite").parquet(path), attempts, wait)
    if before is None:
        spark.sql(f"CREATE TABLE {name} ({df.schema.toDDL()}) USING parquet LOCATION '{path}'")
        return
    if spark.table(name).schema.simpleString() == df.schema.simpleString():
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    else:  # other columns: the catalog has no single step for both
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"CREATE TABLE {name} ({df.schema.toDDL()}) USING parquet LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    fs, root = _filesystem(spark, location)
    kept = {path.rsplit("/", 1)[1], before.rstrip("/").rsplit("/", 1)[1]}
    for old in fs.listStatus(root):
        if old.getPath().getName().startswith("v-") and old.getPath().getName() not in kept:
            fs.delete(old.getPath(), True)


def table_location(spark: SparkSession, name: str) -> str | None:
    """The folder of a catalog's table; None if there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    return next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r["col_name"] == "Location")


def append_table(df: DataFrame, name: str) -> None:
    """Append to a table of the catalog by column name (U1): columns that the table lacks are added to it and null
    in its rows, columns that df lacks are null in the new ones."""
    spark = df.sparkSession
    have = spark.table(name).schema
    new = [f for f in df.schema if f.name not in have.names]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
    target = spark.table(name).schema
    df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in target]).write.mode("append").insertInto(name)


def write_audio_folder(df: DataFrame, folder: str, clip: str = "file_name", audio: str = "audio.bytes") -> None:
    """<split>/audio/<name> clips and a file <split>/metadata.jsonl for each split (K3). Clips are named by
    key, so a task that runs again writes the same ones; a split's metadata is one file by its format."""
    spark = df.sparkSession
    import pyarrow.fs

    def save(rows) -> None:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        for r in rows:
            path = f"{root}/{r['split']}/{r['name']}"
            fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with fs.open_output_stream(path) as out:
                out.write(bytes(r["data"]))

    df.select("split", F.col(clip).alias("name"), F.col(audio).alias("data")).foreachPartition(save)
    stage = f"{folder}/_stage"
    df.drop(audio.split(".")[0]).repartition("split").write.mode("overwrite").option("ignoreNullFields", "false").partitionBy("split").json(stage)
    fs, root = _filesystem(spark, stage)
    parts = fs.globStatus(_filesystem(spark, f"{stage}/split=*/part-*")[1]) or []
    _moved(spark, [(p.getPath(), f"{folder}/{p.getPath().getParent().getName().split('=', 1)[1]}/metadata.jsonl") for p in parts])
    fs.delete(root, True)


__all__ = ["exists", "append_table", "publish", "publish_table", "replace_table", "swap", "with_retry", "write_audio_folder", "write_jsonl", "write_shards"]
