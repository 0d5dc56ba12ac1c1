"""mapInArrow over (kept columns, one text column), with bounded slices."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weft.session import ship


def trim() -> None:
    """Give freed memory back to the system, where the C library can: workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:
        return


def schema_of(df: DataFrame, keep: list[str], added: str) -> StructType:
    """The kept fields of df followed by the fields of a DDL string; an added name wins a clash."""
    new = StructType.fromDDL(added)
    return StructType([df.schema[c] for c in keep if c not in new.names] + new.fields)


def map_text(df: DataFrame, keep: list[str], added: str, make: Callable[[], Callable[[list], list[list]]], text: str = "text", slice_rows: int = 256) -> DataFrame:
    """For every row: the kept columns and what the function made by `make` (once a task) gives for the
    row's text: it takes a list of texts (None for null) and returns one list per added column."""
    ship(df.sparkSession)
    schema = schema_of(df, keep, added)
    names = StructType.fromDDL(added).names
    kept = [c for c in keep if c not in names]
    arrow = arrow_of(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: Callable[[list], list[list]] | None = make()
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                columns = of(part.column(len(kept)).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(i).cast(arrow.field(i).type) for i in range(len(kept))] + [pa.array(c, arrow.field(len(kept) + i).type) for i, c in enumerate(columns)], schema=arrow)
        of = None  # what the task has learned is freed before
        trim()

    return df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("_text")).mapInArrow(run, schema)


def arrow_of(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def arrow_schema(ddl: str) -> pa.Schema:
    return arrow_of(StructType.fromDDL(ddl))


def broadcast(spark: SparkSession, value: object):
    """A broadcast of a value whose size the caller bounds by a parameter."""
    ship(spark)
    return spark.sparkContext.broadcast(value)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """While it lasts, the session has these settings; then those it had before."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def batch_bytes(spark: SparkSession, most: int):
    """While it lasts, jobs send batches of at most about so many bytes to Python. A batch is held several
    times on its way (a vector's buffer doubles as it grows), by every task of an executor."""
    return settings(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": str(most)})


def no_broadcast_joins(spark: SparkSession):
    """While it lasts, joins broadcast nothing by themselves. Each broadcast table is collected and hashed by the
    driver, and stays there until its garbage is collected: an operator of many small joins fills it with them."""
    return settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
