"""Suffix-array dedup: bytes of strings of `min_bytes` that also start in a document with a smaller id.

Blockwise, after difference covers. Documents lie in blocks, and no task holds more than a block or a
suffix bucket. Two suffixes that agree on `min_bytes` bytes have, at some common shift below v, places
that both belong to a difference cover modulo v (counted from each document's start), so

1. the cover sample of every block is ranked first: the distinct strings of q = min_bytes - v + 1 bytes at
   cover places go to buckets by hash range, and each block learns which of its own occur elsewhere too;
2. only suffixes with such a sample within their first v bytes can tie. They go to suffix buckets with the
   text they need: suffixes that share their least q-gram stand next to each other in a document and
   travel as one stretch of text. A block sends equal stretches once, with their smallest id, so a string
   in a third of all documents comes to at most one stretch a block;
3. each bucket sorts its distinct stretches' suffixes, one bucket at a time: the suffixes at cover places of
   the bucket's text are ranked first, by a few bytes and then by doubling along places that lie a modulus
   apart; all suffixes are sorted by as many bytes as the modulus; and where these tie, two suffixes are
   compared by the ranks at the shift at which both are cover places (all ties at once, around pivots).
   Neighbours in this order that agree on `min_bytes` bytes are one string, and each block learns which of
   its strings also start in a document with a smaller id;
4. blocks cut the bytes that those strings cover.

A block and a bucket are all that a task holds: some 4 MB of text with its arrays, or about 3 MB of stretches.
A block sends a row for each bucket that it has something for, so rows grow with the input alone. A string in
very many blocks comes to its bucket once a block.

Defined results: a null text has 0 bytes; null ids come last and count as one id; rows that repeat an id
do not cut each other; an empty table gives an empty result; texts shorter than `min_bytes` stay whole;
extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.arrowmap import arrow_schema
from weft.llm.common import shuffle_width, staged
from weft.session import ship

U = np.uint64
#: Difference covers by their modulus.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27)}
SAMPLE_BITS = 40
LAST_ID = (1 << 63) - 1
MULTIPLIER = U(0x9E3779B97F4A7C15)


def loads(data: bytes) -> np.ndarray:
    """The 64-bit word at every byte place; data ends in padding."""
    return np.ndarray((len(data) - 8,), "<u8", data, strides=(1,))


def hashes(words: np.ndarray, at: np.ndarray | slice, q: int) -> np.ndarray:
    """64-bit hashes of the q-byte strings (q >= 8) at places, or at every place of a slice."""
    out = None
    for k in [*range(0, q - 8, 8), q - 8]:
        w = words[at.start + k : at.stop + k] if isinstance(at, slice) else words[at + k]
        out = w * MULTIPLIER if out is None else (out ^ w) * MULTIPLIER
        out ^= out >> U(29)
    out *= U(0xBF58476D1CE4E5B9)
    return out ^ (out >> U(32))


class Block:
    """A block's text and what each pass derives from it, in the same order every time."""

    def __init__(self, ids: list, lengths: list[int], packed: bytes, min_bytes: int):
        self.ids = np.array([LAST_ID if i is None else i for i in ids], np.int64)
        self.lengths, self.L = np.array(lengths, np.int64), min_bytes
        self.n = int(self.lengths.sum())
        self.data = zstandard.ZstdDecompressor().decompress(packed, max_output_size=self.n + 1) + bytes(min_bytes + 16)
        self.words = loads(self.data)
        self.begin = np.cumsum(self.lengths) - self.lengths
        self.v = max(v for v in COVERS if v == 3 or v <= min_bytes - 19)

    def sample(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cover places, their strings' distinct ranks (SAMPLE_BITS of the hash, ascending), and the
        index of each place's rank."""
        q, cover = self.L - self.v + 1, np.array(COVERS[self.v])
        places = []
        for b, n in zip(self.begin.tolist(), self.lengths.tolist()):
            if n >= self.L:
                grid = (np.arange(0, n - q + 1, self.v)[:, None] + cover).ravel()
                places.append(b + grid[grid <= n - q])
        at = np.concatenate(places) if places else np.zeros(0, np.int64)
        rank, index = np.unique(hashes(self.words, at, q) >> U(64 - SAMPLE_BITS), return_inverse=True)
        return at, rank, index

    def suffixes(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Stretches of suffixes that can tie: first and last suffix, anchor, and document."""
        at, rank, index = self.sample()
        local = np.bincount(index, minlength=len(rank)) > 1
        tie = np.zeros(self.n + 1, np.int32)
        tie[at[(shared | local)[index]] + 1] = 1
        np.cumsum(tie, out=tie)
        can = np.zeros(self.n, bool)
        m = self.n - self.L + 1
        if m <= 0:
            return (np.zeros(0, np.int64),) * 4
        can[:m] = tie[self.v : self.v + m] > tie[:m]
        for b, n in zip(self.begin.tolist(), self.lengths.tolist()):
            can[max(b, b + n - self.L + 1) : b + n] = False
        del tie
        q = 16 if self.L >= 24 else 8
        width = self.L - q + 1  # q-grams within a suffix's first min_bytes bytes
        least = hashes(self.words, slice(0, self.n), q)
        bits = U(max(1, self.n.bit_length()))
        least = (least >> bits << bits) | np.arange(self.n, dtype=U)
        least = np.concatenate([least, np.full(width, np.iinfo(np.uint64).max, U)])
        reach = 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[: self.n], least[width - reach : width - reach + self.n])
        anchor = (least[: self.n] & ((U(1) << bits) - U(1))).astype(np.int64)
        p = np.flatnonzero(can)
        if not len(p):
            return (np.zeros(0, np.int64),) * 4
        doc = np.searchsorted(self.begin, p, side="right") - 1
        new = np.ones(len(p), bool)
        new[1:] = (p[1:] != p[:-1] + 1) | (anchor[p[1:]] != anchor[p[:-1]]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(p)) - 1
        return p[first], p[last], anchor[p[first]], doc[first]

    def stretches(self, shared: np.ndarray, buckets: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The distinct stretches by bucket (their texts, smallest ids and buckets), and for each place of one:
        first suffix, number of suffixes, document id, and number of its stretch."""
        first, last, anchor, doc = self.suffixes(shared)
        q = 16 if self.L >= 24 else 8
        bucket = (hashes(self.words, anchor, q) % U(buckets)).astype(np.int64) if len(first) else first
        data, own, known, numbers = self.data, self.ids[doc], {}, []
        for a, b in zip(first.tolist(), (last + self.L).tolist()):
            numbers.append(known.setdefault(data[a:b], len(known)))
        number = np.array(numbers, np.int64)
        least = np.full(len(known), LAST_ID, np.int64)
        np.minimum.at(least, number, own)
        where = np.zeros(len(known), np.int64)
        where[number] = bucket
        order = np.argsort(where, kind="stable")
        place = np.empty(len(known), np.int64)
        place[order] = np.arange(len(known))
        texts = list(known)
        return [texts[i] for i in order.tolist()], least[order], where[order], first, last - first + 1, own, place[number]


class Ranks:
    """Dense ranks of places of a text by more and more of their bytes."""

    def __init__(self, words: np.ndarray, at: np.ndarray):
        self.words, self.at, self.bits = words, at, max(1, int(len(at)).bit_length())
        self.rank, self.order = np.zeros(len(at), np.int32), np.arange(len(at))
        self.largest = 0

    def refine(self, key: np.ndarray, bits: int) -> None:
        """Rank by the ranks so far, then by keys of so many bits."""
        own = max(1, int(self.largest).bit_length())
        if own + bits > 64:
            raise ValueError("keys too wide")
        key = (self.rank.astype(U) << U(bits)) | key.astype(U)
        if own + bits + self.bits <= 64:  # places in the low bits: sorting values is several times as fast
            packed = (key << U(self.bits)) | np.arange(len(key), dtype=U)
            packed.sort()
            self.order = (packed & U((1 << self.bits) - 1)).view(np.int64)
            packed >>= U(self.bits)
            key = packed
        else:
            self.order = np.argsort(key, kind="stable")
            key = key[self.order]
        dense = np.zeros(len(key), np.int32)
        np.cumsum(key[1:] != key[:-1], out=dense[1:], dtype=np.int32)
        self.rank[self.order] = dense
        self.largest = int(dense[-1]) if len(dense) else 0

    def by_bytes(self, width: int) -> None:
        done = 0
        while done < width:
            own = max(1, int(self.largest).bit_length())
            n = min(width - done, 7, max(1, (64 - own - self.bits) // 8))
            word = self.words[self.at + done].byteswap()  # the first byte counts most
            self.refine(word >> U(64 - 8 * n), 8 * n)
            done += n


def _shifts(v: int) -> np.ndarray:
    """For residues i and j, the least shift at which both are in the cover."""
    cover = set(COVERS[v])
    return np.array([[next(d for d in range(v) if (i + d) % v in cover and (j + d) % v in cover) for j in range(v)] for i in range(v)])


def suffix_order(words: np.ndarray, size: int, at: np.ndarray, min_bytes: int) -> np.ndarray:
    """The order of the suffixes at places `at` of a text of `size` bytes, by at least their first min_bytes
    bytes; words go on for min_bytes + 16 bytes."""
    v = 13 if min_bytes >= 13 else 7
    cover = np.array(COVERS[v])
    number = np.full(v, -1)
    number[cover] = np.arange(len(cover))
    places = (np.arange(0, size, v)[:, None] + cover).ravel()
    sample, length = Ranks(words, places[places < size + min_bytes - v]), v
    sample.by_bytes(v)
    while length < min_bytes:  # a place one length on is a cover place too
        step = length // v * len(cover)
        ahead = np.zeros(len(sample.rank), np.int32)
        ahead[:-step] = sample.rank[step:] + 1
        sample.refine(ahead, max(1, int(sample.largest + 1).bit_length()))
        length *= 2
    rank, shift = sample.rank, _shifts(v)
    mine = Ranks(words, at)
    mine.by_bytes(v)
    order, residue = mine.order, at % v
    begin = mine.rank[order]  # a run of equal prefixes has one number
    run = np.flatnonzero(np.append(True, begin[1:] != begin[:-1])) if len(order) else np.zeros(0, np.int64)
    ends = np.append(run[1:], len(order))
    tied = ends - run > 1
    run, ends = run[tied], ends[tied]
    while len(run):
        sizes = ends - run
        group = np.repeat(np.arange(len(run)), sizes)
        slot = np.repeat(run - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        one, pivot = order[slot], np.repeat(order[(run + ends) // 2], sizes)
        d = shift[residue[one], residue[pivot]]
        x, y = at[one] + d, at[pivot] + d
        side = np.sign(rank[x // v * len(cover) + number[x % v]] - rank[y // v * len(cover) + number[y % v]]) + 1
        key = group * 3 + side
        bits = max(1, len(key).bit_length())
        packed = (key.astype(U) << U(bits)) | np.arange(len(key), dtype=U)
        packed.sort()
        order[slot] = one[(packed & U((1 << bits) - 1)).astype(np.int64)]
        key = (packed >> U(bits)).astype(np.int64)
        cut = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        stop = np.append(cut[1:], len(key))
        open_ = (stop - cut > 1) & (key[cut] % 3 != 1)
        run, ends = slot[cut[open_]], slot[stop[open_] - 1] + 1
    return order


def blocks_of(docs: DataFrame, id: str, text: str, block_bytes: int) -> DataFrame:
    """(block, ids, lengths, text): the documents in blocks of about block_bytes, compressed."""
    ddl = "block long, ids array<bigint>, lengths array<bigint>, text binary"
    schema = arrow_schema(ddl)

    def run(batches):
        pack, number = zstandard.ZstdCompressor(level=3), TaskContext.get().partitionId() << 32
        ids, lengths, held, size = [], [], [], 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((number, ids, lengths, pack.compress(b"".join(held))), schema)], schema=schema)

        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1)):
                data = (t.as_py() or "").encode("utf-8", "surrogatepass")
                ids.append(i.as_py())
                lengths.append(len(data))
                held.append(data)
                size += len(data)
                if size >= block_bytes:
                    yield flush()
                    number += 1
                    ids, lengths, held, size = [], [], [], 0
        if ids:
            yield flush()

    return docs.select(F.col(f"`{id}`").cast("long"), F.col(f"`{text}`").cast("string")).mapInArrow(run, ddl)


def _each_block(blocks: DataFrame, ddl: str, function, min_bytes: int) -> DataFrame:
    """function(Block, row) -> rows, over every block and its further columns."""
    schema = arrow_schema(ddl)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                rows = function(Block(row["ids"], row["lengths"], row["text"], min_bytes), row)
                for at in range(0, len(rows), 4096):
                    yield pa.RecordBatch.from_pylist(rows[at : at + 4096], schema=schema)

    return blocks.mapInArrow(run, ddl)


def _by_block(answers: DataFrame, name: str) -> DataFrame:
    return answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "bits"))).alias(name))


def _shared(row: dict, rank: np.ndarray, buckets: int) -> np.ndarray:
    """What the sample's buckets answered, for every rank of the block."""
    filled, at = np.unique(_bucket(rank, buckets), return_index=True)
    ends = np.append(at[1:], len(rank))
    answers = {x["bucket"]: x["bits"] for x in row["shared"] or []}
    out = np.zeros(len(rank), bool)
    for k, a, b in zip(filled.tolist(), at.tolist(), ends.tolist()):
        out[a:b] = np.unpackbits(np.frombuffer(answers[k], np.uint8), count=b - a).astype(bool)
    return out


def _bucket(rank: np.ndarray, buckets: int) -> np.ndarray:
    return ((rank * U(buckets)) >> U(SAMPLE_BITS)).astype(np.int64)


def rank_sample(blocks: DataFrame, min_bytes: int, buckets: int) -> DataFrame:
    """(block, bucket, bits): for a block's ranks of a bucket in order, whether another block has them."""

    def send(block: Block, row: dict) -> list[dict]:
        _, rank, _ = block.sample()
        filled, at = np.unique(_bucket(rank, buckets), return_index=True)
        rows = []
        for k, a, b in zip(filled.tolist(), at.tolist(), np.append(at[1:], len(rank)).tolist()):
            step = np.diff(rank[a:b])
            width = max(1, -(-int(step.max()).bit_length() // 8)) if len(step) else 1
            rows.append({"block": row["block"], "bucket": k, "first": int(rank[a]), "width": width, "steps": np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()})
        return rows

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        lists = []
        for first, width, steps in zip(pdf["first"], pdf["width"], pdf["steps"]):
            step = np.zeros((len(steps) // width, 8), np.uint8)
            step[:, :width] = np.frombuffer(steps, np.uint8).reshape(-1, width)
            lists.append(np.concatenate([np.array([first], U), step.view(U).ravel()]).cumsum(dtype=U))
        every = np.concatenate(lists)
        every.sort()
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        del every
        bits = []
        for ranks in lists:
            i = np.searchsorted(twice, ranks)
            bits.append(np.packbits((i < len(twice)) & (twice[np.minimum(i, len(twice) - 1)] == ranks)).tobytes() if len(twice) else np.packbits(np.zeros(len(ranks), bool)).tobytes())
        return pd.DataFrame({"block": pdf["block"], "bucket": pdf["bucket"], "bits": bits})

    sent = _each_block(blocks, "block long, bucket int, first long, width int, steps binary", send, min_bytes)
    return sent.groupBy("bucket").applyInPandas(answer, "block long, bucket int, bits binary")


def sort_suffixes(blocks: DataFrame, min_bytes: int, sample_buckets: int, buckets: int) -> DataFrame:
    """(block, bucket, bits): for every suffix of a block's stretches of a bucket, in order, whether an
    equal one starts in a document with a smaller id than the stretch's."""
    L = min_bytes

    def send(block: Block, row: dict) -> list[dict]:
        _, rank, _ = block.sample()
        pack, rows = zstandard.ZstdCompressor(level=3), []
        texts, least, bucket = block.stretches(_shared(row, rank, sample_buckets), buckets)[:3]
        filled, at = np.unique(bucket, return_index=True)
        for k, a, b in zip(filled.tolist(), at.tolist(), np.append(at[1:], len(texts)).tolist()):
            body = np.array([len(s) for s in texts[a:b]], "<u4").tobytes() + least[a:b].astype("<i8").tobytes() + b"".join(texts[a:b])
            rows.append({"block": row["block"], "bucket": k, "stretches": b - a, "body": pack.compress(body)})
        return rows

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        unpack = zstandard.ZstdDecompressor()
        known: dict[bytes, int] = {}
        numbers, ids, cuts = [], [], [0]
        for n, body in zip(pdf["stretches"], pdf["body"]):
            data = unpack.decompress(body)
            ids.append(np.frombuffer(data, "<i8", n, 4 * n))
            end = 12 * n
            for size in np.frombuffer(data, "<u4", n).tolist():
                numbers.append(known.setdefault(data[end : end + size], len(known)))
                end += size
            cuts.append(len(numbers))
        number, owner = np.array(numbers, np.int64), np.concatenate(ids)
        length = np.array([len(t) for t in known], np.int64)
        text = b"".join(known)
        size, words = len(text), loads(text + bytes(2 * L + 32))
        del text, known
        per = length - L + 1
        begin = np.cumsum(length) - length
        base = np.cumsum(per) - per
        at = np.repeat(begin - base, per) + np.arange(int(per.sum()))
        order = suffix_order(words, size, at, L)
        place = at[order]
        same = np.ones(max(len(order) - 1, 0), bool)
        for k in [*range(0, L - 8, 8), L - 8]:
            w = words[place + k]
            same &= w[1:] == w[:-1]
        first = np.flatnonzero(np.append(True, ~same)) if len(order) else np.zeros(0, np.int64)
        of_text = np.full(len(length), LAST_ID, np.int64)
        np.minimum.at(of_text, number, owner)
        least = np.minimum.reduceat(np.repeat(of_text, per)[order], first) if len(first) else first
        smallest = np.empty(len(order), np.int64)
        smallest[order] = np.repeat(least, np.diff(np.append(first, len(order))))
        bits = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            some, count = number[a:b], per[number[a:b]]
            step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            bits.append(np.packbits(smallest[np.repeat(base[some], count) + step] < np.repeat(owner[a:b], count)).tobytes())
        return pd.DataFrame({"block": pdf["block"], "bucket": pdf["bucket"], "bits": bits})

    sent = _each_block(blocks, "block long, bucket int, stretches int, body binary", send, min_bytes)
    return sent.groupBy("bucket").applyInPandas(answer, "block long, bucket int, bits binary")


def deduplicate(docs: DataFrame, id: str = "doc_id", text: str = "text", min_bytes: int = 50, block_bytes: int = 4 << 20, with_text: bool = False) -> DataFrame:
    """A row for each document: id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, and
    the kept bytes as `kept` if asked for. min_bytes is 10 at least."""
    if min_bytes < 10:
        raise ValueError("min_bytes must be 10 or more")
    spark = docs.sparkSession
    ship(spark)
    blocks = staged(blocks_of(docs, id, text, block_bytes), "blocks")
    total = blocks.select(F.coalesce(F.sum(F.expr("aggregate(lengths, 0L, (a, x) -> a + x)")), F.lit(0))).first()[0]
    # Buckets of about 4 million ranks, and of about 3 MB of stretches, at any input size.
    sample_buckets = max(shuffle_width(spark), math.ceil(total / 20e6))
    buckets = max(shuffle_width(spark), math.ceil(total / 6e6))
    shared = staged(rank_sample(blocks, min_bytes, sample_buckets), "shared")
    known = blocks.join(_by_block(shared, "shared"), "block", "left")
    ties = staged(sort_suffixes(known, min_bytes, sample_buckets, buckets), "ties")
    result = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text

    def cut(block: Block, row: dict) -> list[dict]:
        _, rank, _ = block.sample()
        texts, least, bucket, first, count, own, number = block.stretches(_shared(row, rank, sample_buckets), buckets)
        # The answers for all distinct stretches in one row of numbers, in the order of their buckets.
        size = np.array([len(t) for t in texts], np.int64) - min_bytes + 1
        base = np.cumsum(size) - size
        filled, at = np.unique(bucket, return_index=True)
        total = np.add.reduceat(size, at) if len(at) else at
        bits = {x["bucket"]: x["bits"] for x in row["ties"] or []}
        answer = np.concatenate([np.unpackbits(np.frombuffer(bits[k], np.uint8), count=n) for k, n in zip(filled.tolist(), total.tolist())] or [np.zeros(0, np.uint8)]).astype(bool)
        edge = np.zeros(block.n + 1, np.int64)
        later = own > least[number]  # the whole stretch starts in a document with a smaller id
        np.add.at(edge, first[later], 1)
        np.add.at(edge, first[later] + count[later] - 1 + min_bytes, -1)
        first, count, number = first[~later], count[~later], number[~later]
        step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        gone = (np.repeat(first, count) + step)[answer[np.repeat(base[number], count) + step]]
        edge += np.bincount(gone, minlength=len(edge)) - np.bincount(gone + min_bytes, minlength=len(edge))
        covered = np.cumsum(edge[:-1]) > 0
        raw = np.frombuffer(block.data, np.uint8, block.n)
        rows = []
        for i, b, n in zip(row["ids"], block.begin.tolist(), block.lengths.tolist()):
            c = covered[b : b + n]
            kept = raw[b : b + n][~c].tobytes()
            spans = int(np.count_nonzero(c[1:] & ~c[:-1]) + c[0]) if n else 0
            rows.append({"id": i, "n_bytes": n, "n_removed": n - len(kept), "n_spans": spans, "kept_sha256": hashlib.sha256(kept).hexdigest()} | ({"kept": kept} if with_text else {}))
        return rows

    return _each_block(known.join(_by_block(ties, "ties"), "block", "left"), result, cut, min_bytes).withColumnRenamed("id", id)
