"""Packing of documents into training sequences by best-fit decreasing.

A document's ids, end id included, are first cut into full windows; the rest of each is a piece. Pieces
are dealt evenly over shards of bounded size; each shard packs longest first: a segment tree over
remaining capacities gives the tightest open sequence that still holds the piece, and a new sequence
opens where none does. Only lengths are shuffled, not ids.

Defined results: a null or empty text is a document of the end id alone; repeated rows are documents of
their own; null ids pass through; an empty table gives an empty result; columns not kept are dropped, and a
result's name wins over a kept column of that name.
A sequence ends padded to its capacity unless its length is a power of two (`padding`).
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weft.llm.arrowmap import arrow_of, schema_of, trim
from weft.llm.common import staged
from weft.llm.tokens import encoder, with_end
from weft.session import ship

PIECE = "start long, length long, ids_crc32 long, doc_tokens long"
PLACE = "sequence_id long, offset long, padding long"


class OpenSequences:
    """Open sequences by remaining capacity, under a segment tree of their numbers."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, room: int, sequence: int) -> None:
        self.at[room].append(sequence)
        node = self.leaves + room
        while node:
            self.tree[node] += 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """The sequence with the least room that is at least `length`, removed; with its room."""
        node = self.leaves + length
        if not self.tree[node]:
            while node > 1 and (node & 1 or not self.tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.tree[2 * node] else 2 * node + 1
        room = node - self.leaves
        while node:
            self.tree[node] -= 1
            node >>= 1
        return room, self.at[room].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset for every length (ties in the order given)."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_, n = OpenSequences(capacity), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        got = open_.take(length)
        if got is None:
            got, n = (capacity, n), n + 1
        room, s = got
        sequence[i], offset[i] = s, capacity - room
        if room > length:
            open_.put(room - length, s)
    return sequence, offset


def cut(docs: DataFrame, keep: list[str], tokenizer: str, capacity: int = 2048, end_id: int = 1, text: str = "text") -> DataFrame:
    """A row for each piece of every document: the kept columns and PIECE, and `ids` (little-endian
    unsigned 32-bit) if asked for by `keep` holding 'ids'."""
    ship(docs.sparkSession)
    with_ids = "ids" in keep
    added = PIECE + ", ids binary" * with_ids
    schema = schema_of(docs, [c for c in keep if c != "ids"], added)
    kept = [c for c in keep if c not in StructType.fromDDL(PIECE).names and c != "ids"]
    arrow = arrow_of(schema)

    def run(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                data, total = with_end(*enc.encode_column(rows.column(len(kept))), end_id)
                of = np.repeat(np.arange(len(total)), -(-total // capacity))
                start = (np.arange(len(of)) - np.searchsorted(of, of)) * capacity
                length = np.minimum(capacity, total[of] - start)
                view, ends = memoryview(data.view(np.uint8)), np.cumsum(length) * 4
                pieces = [view[e - 4 * n : e] for e, n in zip(ends.tolist(), length.tolist())]
                columns = [start, length, [zlib.crc32(x) for x in pieces], total[of]] + [[bytes(x) for x in pieces]] * with_ids
                own = [rows.column(i).take(pa.array(of)).cast(arrow.field(i).type) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays(own + [pa.array(c, arrow.field(len(kept) + i).type) for i, c in enumerate(columns)], schema=arrow)
        trim()

    return docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("_text")).mapInArrow(run, schema)


def pack(docs: DataFrame, keep: list[str], tokenizer: str, capacity: int = 2048, end_id: int = 1, text: str = "text", shard_pieces: int = 4096) -> DataFrame:
    """A row for each piece: the kept columns, PIECE, sequence_id, offset, and the `padding` of its
    sequence. A shard holds about `shard_pieces` pieces at any input size; what a shard's last
    sequences leave open is the method's only loss from sharding."""
    spark = docs.sparkSession
    ship(spark)
    keep = [c for c in keep if c not in StructType.fromDDL(PLACE).names]
    pieces = staged(cut(docs, keep, tokenizer, capacity, end_id, text).withColumn("_weft_row", F.monotonically_increasing_id()), "pieces")
    n = pieces.count()
    shards = max(1, math.ceil(n / shard_pieces))
    own = [c for c in pieces.columns if c != "_weft_row"]
    result = StructType([pieces.schema[c] for c in own] + StructType.fromDDL(PLACE).fields)

    def place(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_weft_row", ignore_index=True)
        lengths = pdf["length"].to_numpy()
        sequence, offset = best_fit_decreasing(lengths, capacity)
        used = np.bincount(sequence, lengths).astype(np.int64)
        padding = np.where(used & (used - 1) == 0, 0, capacity - used)
        return pdf[own].assign(sequence_id=sequence + (int(key[0]) << 32), offset=offset, padding=padding[sequence])

    return pieces.withColumn("_weft_shard", F.pmod(F.xxhash64("_weft_row"), F.lit(shards))).groupBy("_weft_shard").applyInPandas(place, result)
