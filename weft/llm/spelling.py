"""Spelling variants: words one edit apart, each led to its most frequent near word.

A word is cut into two segments, its first len // 2 code points and the rest. If one edit turns word w into
word x, one of w's segments stands in x untouched: the first at x's start or the second at x's end. So the
vocabulary's segments are dealt into automaton shards by kind and first three code points, and a word is
sent only to the shards that can hold a segment of a word of its length or of one more or less. A shard's
task builds an Aho-Corasick automaton of its segments, scans its words with it, keeps the hits whose offset
and length fit, and verifies the distance. A pair that both segments find counts at the first only. What
leaves a task is one row a word with the number and the best of its near words, never the pairs.

Shards are cut by counts: one with many segments into blocks, one with many words into slices, so no task
holds more than about BLOCK segments, whatever the vocabulary. Roots are found by pointer jumping over
staged tables; a form is at least twice as frequent as its word, so chains end after log2(n) steps.

Defined results: null and empty texts hold no words; a null id counts as empty text in the choice of typos;
repeated rows count each time; an empty table gives an empty result; other columns are ignored. Very long
runs are words like others.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.arrowmap import arrow_schema
from weft.llm.common import drop, spread, staged
from weft.session import ship

#: Segments that an automaton holds and words that one task scans with it, about, at most.
BLOCK = 8192
#: Automaton shards of each kind of segment before they are cut; a row each is broadcast.
SHARDS = 8192
#: First code points of a segment that choose its shard.
ROUTE = 3
#: Distinct words that a counting task holds before it hands them on.
HELD_WORDS = 200_000
#: Words up to this length are verified together in byte arrays, longer ones one by one.
WIDTH = 40

#: What a byte of Latin-1 text stands for: A-Z lower-cased, letters themselves, all else a blank.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs(text: str) -> list[bytes]:
    """The maximal runs of A-Z, a-z and U+00C0 to U+00FF of a text, A-Z lower-cased, in Latin-1."""
    return text.encode("latin-1", "replace").translate(FOLD).split()


def _typo(word: bytes, prefix: int, every: int) -> bytes:
    """The word without one code point where `every` divides the crc32 of the id and the word."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), prefix)
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def vocabulary(docs: DataFrame, id: str = "doc_id", text: str = "text", min_length: int = 5, min_count: int = 3, typo_every: int | None = None) -> DataFrame:
    """(word, n) of the words of at least `min_length` code points that occur `min_count` times. With
    `typo_every`, one in so many of the (document, word) pairs has a code point deleted first."""
    ship(docs.sparkSession)
    schema = arrow_schema("word string, n long")

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], schema=schema)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for k in range(batch.num_rows):
                value, name = batch.column(1)[k].as_py(), batch.column(0)[k].as_py()
                own = Counter(w for w in runs(value) if len(w) >= min_length)
                if typo_every:
                    prefix = zlib.crc32(f"{'' if name is None else name}:".encode())
                    for w, n in own.items():
                        w = _typo(w, prefix, typo_every)
                        if len(w) >= min_length:
                            held[w] += n
                else:
                    held.update(own)
                if len(held) > HELD_WORDS:
                    yield rows(held)
                    held.clear()
        yield rows(held)

    named = docs.filter(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{id}`").cast("string"), F.col(f"`{text}`").cast("string"))
    return spread(named).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _shard(kind: int, segment: str) -> str:
    """SQL of the automaton shard of a segment of a kind."""
    return f"cast(2 * pmod(xxhash64(left({segment}, {ROUTE})), {SHARDS}) + {kind} as int)"


def _dealt(words: DataFrame) -> DataFrame:
    """(shard, block, slice, side, word, n): side 0 the owners of a block's segments, side 1 the words that
    are scanned with it."""
    head = "length(word) div 2"
    own = words.select("word", "n", F.explode(F.expr(f"array({_shard(0, f'left(word, {head})')}, {_shard(1, f'substring(word, {head} + 1)')})")).alias("shard"))
    # A word of l code points that is one edit from this one: its first segment is at 0, its second at the end.
    there = f"flatten(transform(sequence(length(word) - 1, length(word) + 1), l -> array({_shard(0, 'left(word, l div 2)')}, {_shard(1, 'substring(word, length(word) - l + l div 2 + 1)')})))"
    scanned = words.select("word", "n", F.explode(F.expr(f"array_distinct({there})")).alias("shard"))
    cut = lambda n: F.ceil(n / BLOCK).cast("int")
    counts = own.groupBy("shard").agg(cut(F.count("*")).alias("blocks")).join(scanned.groupBy("shard").agg(cut(F.count("*")).alias("slices")), "shard")
    counts = F.broadcast(staged(counts, "shards"))  # at most 2 * SHARDS rows
    place = lambda n, seed: F.pmod(F.xxhash64("word", F.lit(seed)), n).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    owners = own.join(counts, "shard").select("shard", place(F.col("blocks"), 1).alias("block"), upto("slices").alias("slice"), F.lit(0).alias("side"), "word", "n")
    readers = scanned.join(counts, "shard").select("shard", upto("blocks").alias("block"), place(F.col("slices"), 2).alias("slice"), F.lit(1).alias("side"), "word", "n")
    keys = ["shard", "block", "slice"]
    return owners.unionByName(readers).repartition(*keys).sortWithinPartitions(*keys, "side")


def _table(words: list[bytes], right: bool, fill: int) -> np.ndarray:
    """Bytes of words of up to WIDTH in rows, at the left or the right edge; longer ones stay empty."""
    rows = [(w.rjust if right else w.ljust)(WIDTH + 1, bytes([fill])) if len(w) <= WIDTH else bytes([fill]) * (WIDTH + 1) for w in words]
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(words), WIDTH + 1)


def shared_ends(x: bytes, w: bytes) -> tuple[int, int]:
    """Lengths of the common prefix and of the common suffix."""
    short = min(len(x), len(w))
    first = next((k for k in range(short) if x[k] != w[k]), short)
    return first, next((k for k in range(short) if x[-1 - k] != w[-1 - k]), short)


class Shard:
    """The automaton of the segments of one kind of some words."""

    def __init__(self, kind: int, words: list[bytes], counts: list[int]):
        import ahocorasick

        self.kind, order = kind, {}
        segment = [order.setdefault(w[: len(w) // 2] if kind == 0 else w[len(w) // 2 :], len(order)) for w in words]
        sizes = np.array([len(w) for w in words], np.int64)
        by = np.lexsort((sizes, segment))
        self.words, self.sizes = [words[i] for i in by], sizes[by]
        self.counts = np.array(counts, np.int64)[by]
        self.places = (np.array(segment, np.int64)[by] << 32) + self.sizes
        self.lengths = np.array([len(s) for s in order], np.int64)
        self.left, self.right = _table(self.words, False, 1), _table(self.words, True, 1)
        self.automaton = ahocorasick.Automaton()
        for s, k in order.items():
            self.automaton.add_word(s.decode("latin-1"), k)
        self.automaton.make_automaton()

    def near(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place in words, owner) of the pairs one edit apart, some at a time."""
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes + 1) - 1
        found = [x for hit in self.automaton.iter(b"\n".join([*words, b""]).decode("latin-1")) for x in hit]
        last, segment = np.array(found, np.int64).reshape(-1, 2).T
        at = np.searchsorted(ends, last)
        fits = last - (ends - sizes)[at] + 1 == self.lengths[segment] if self.kind == 0 else last + 1 == ends[at]
        at, segment = at[fits], segment[fits]
        low, high = (np.searchsorted(self.places, (segment << 32) + sizes[at] + d) for d in (-1, 2))
        left, right = _table(words, False, 0), _table(words, True, 0)
        total, first = np.cumsum(high - low), 0
        while first < len(at):
            until = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + 100_000)))
            many = (high - low)[first:until]
            x = np.repeat(at[first:until], many)
            w = np.arange(len(x)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low[first:until], many)
            yield self._verified(words, sizes, left, right, x, w)
            first = until

    def _verified(self, words, sizes, left, right, x, w) -> tuple[np.ndarray, np.ndarray]:
        longest = np.maximum(sizes[x], self.sizes[w])
        start, end = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        short = longest <= WIDTH
        xs, ws = x[short], w[short]
        start[short] = np.argmax(left[xs] != self.left[ws], axis=1)
        end[short] = np.argmax((right[xs] != self.right[ws])[:, ::-1], axis=1)
        for k in np.flatnonzero(~short).tolist():
            start[k], end[k] = shared_ends(words[x[k]], self.words[w[k]])
        near = (start + end >= longest - 1) & (start < longest)
        if self.kind == 1:
            near &= start < self.sizes[w] // 2
        return x[near], w[near]


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words of (word, n) that have near words: their number, and the one
    of largest n (ties: smallest)."""
    ship(words.sparkSession)
    ddl = "word string, n_near long, best_n long, best string"
    schema = arrow_schema(ddl)

    def best(shard: Shard, words: list[bytes]) -> pa.RecordBatch:
        number, top = np.zeros(len(words), np.int64), {}
        for x, w in shard.near(words):
            number += np.bincount(x, minlength=len(words))
            n = shard.counts[w]
            order = np.lexsort((-n, x))
            xs = x[order]
            lead = np.flatnonzero(np.concatenate([[True], xs[1:] != xs[:-1]])) if len(xs) else xs
            level = np.repeat(n[order][lead], np.diff(np.append(lead, len(xs))))
            for i, k in zip(xs[n[order] == level].tolist(), w[order][n[order] == level].tolist()):
                own = (-int(shard.counts[k]), shard.words[k])
                if i not in top or own < top[i]:
                    top[i] = own
        some = np.flatnonzero(number).tolist()
        columns = ([words[i].decode("latin-1") for i in some], number[some], [-top[i][0] for i in some], [top[i][1].decode("latin-1") for i in some])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, owners, counts, shard = None, [], [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in range(4)], axis=1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                *own, side = keys[a].tolist()
                words = [w.encode("latin-1") for w in batch.column(4).slice(a, b - a).to_pylist()]
                if own != key:
                    key, owners, counts, shard = own, [], [], None
                if side == 0:
                    owners += words
                    counts += batch.column(5).slice(a, b - a).to_pylist()
                elif owners:
                    shard = shard or Shard(own[0] % 2, owners, counts)
                    yield best(shard, words)

    found = _dealt(words).mapInArrow(scan, ddl)
    order = F.struct((-F.col("best_n")).alias("least"), F.col("best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(order).alias("b")).select("word", "n_near", (-F.col("b.least")).alias("best_n"), F.col("b.best").alias("best"))


def variants(words: DataFrame, factor: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n): its form is its most frequent near
    word if that is `factor` times as frequent, its root where following forms ends."""
    words = staged(words, "words")
    near = near_words(words)
    is_form = F.col("best_n") >= factor * F.col("n")
    formed = words.join(near, "word", "left").select("word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n"))
    formed = staged(formed, "forms")
    roots = _roots(formed.filter("form is not null").select("word", F.col("form").alias("up")))
    out = formed.join(roots, "word", "left") if roots is not None else formed.withColumn("up", F.lit(None).cast("string"))
    return out.select("word", "form", F.coalesce("up", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame | None:
    """(word, up) with up led to the end of its chain: each round doubles the steps. None if there are none."""
    now = staged(links, "links")
    if now.isEmpty():
        return None
    while True:
        on = now.select(F.col("word").alias("up"), F.col("up").alias("next"))
        further = staged(now.join(on, "up", "left").select("word", F.coalesce("next", "up").alias("up"), F.col("next").isNotNull().alias("moved")), "links")
        moved = not further.filter("moved").isEmpty()
        drop(now)
        now = further
        if not moved:
            return now.select("word", "up")
