"""Token-ID output: documents as Simple-8b files in ascending id order, and their reader.

Rows are range-partitioned and sorted by id; each task tokenizes its range and writes files of about
`file_ids` ids (format: ``weft.llm.simple8b``), each with the ids and lengths of its documents. Files are
stored as binary values of a Parquet table, one row a file: Spark's committer then makes retried tasks
harmless on every file system, and the reader needs no listing or seeking of its own.

Defined results: a null or empty text is a document of the end id alone; null ids come first; repeated
ids stay next to each other (by text); an empty table gives an empty table; other columns are dropped.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import simple8b
from weft.llm.arrowmap import arrow_schema
from weft.llm.common import input_width
from weft.llm.tokens import encoder, with_end
from weft.session import ship

FILES = "part int, first long, n_ids long, doc_ids array<bigint>, lengths array<bigint>, payload binary"


def write(docs: DataFrame, path: str, tokenizer: str, id: str = "doc_id", text: str = "text", end_id: int = 2, file_ids: int = 1 << 20, partitions: int | None = None) -> None:
    """Write the files of docs below `path`. `first` is a file's first id's number within its part; parts
    follow the order of document ids."""
    spark = docs.sparkSession
    ship(spark)
    schema = arrow_schema(FILES)

    def files(batches):
        enc, part, first = encoder(tokenizer), TaskContext.get().partitionId(), 0
        ids, lengths, pieces, n = [], [], [], 0

        def flush():
            nonlocal first, ids, lengths, pieces, n
            data = simple8b.encode(np.concatenate(pieces))
            values = (pa.array([x], t.type) for x, t in zip((part, first, n, pa.concat_arrays(ids), np.concatenate(lengths), data), schema))
            first, ids, lengths, pieces, n = first + n, [], [], [], 0
            return pa.RecordBatch.from_arrays(list(values), schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                tokens, counts = with_end(*enc.encode_column(rows.column(1)), end_id)
                ids.append(rows.column(0))
                lengths.append(counts)
                pieces.append(tokens)
                n += len(tokens)
                if n >= file_ids:
                    yield flush()
        if n:
            yield flush()
        pa.default_memory_pool().release_unused()  # the worker lives on between tasks

    rows = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    # Ranges of (id, first characters): rows that share an id, or have none, are no range of their own.
    ranged = rows.repartitionByRange(partitions or input_width(rows), F.col("id"), F.left("text", F.lit(32)))
    ordered = ranged.sortWithinPartitions("id", "text")
    ordered.mapInArrow(files, FILES).write.parquet(path)


def starts(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each part: a row for each writing task."""
    sums = spark.read.parquet(path).groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    before, rows = 0, []
    for r in sums:
        rows.append((r["part"], before))
        before += r["n"]
    return spark.createDataFrame(rows, "part int, before long")


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """A row for each document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and
    `ids` if asked for."""
    ship(spark)
    ddl = "part int, doc_id long, local long, n_tokens long, ids_crc32 long" + ", ids array<bigint>" * with_ids
    schema = arrow_schema(ddl)

    def documents(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                part, first = row.column(0)[0].as_py(), row.column(1)[0].as_py()
                doc_ids, lengths = row.column(2)[0].as_py(), np.array(row.column(3)[0].as_py(), np.int64)
                ids = simple8b.decode(row.column(4)[0].as_py()).astype("<u4")
                ends = np.cumsum(lengths)
                data = memoryview(ids.tobytes())
                crc = [zlib.crc32(data[4 * (b - n) : 4 * b]) for b, n in zip(ends.tolist(), lengths.tolist())]
                columns = [np.full(len(ends), part), doc_ids, first + ends - lengths, lengths, crc]
                if with_ids:
                    columns.append([ids[b - n : b] for b, n in zip(ends, lengths)])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    files = spark.read.parquet(path).select("part", "first", "doc_ids", "lengths", "payload")
    # As many rows as there were writing tasks, and 16 bytes each: small enough to send to every task.
    found = files.mapInArrow(documents, ddl).join(F.broadcast(starts(spark, path)), "part")
    return found.select("doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
