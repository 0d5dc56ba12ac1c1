"""N-gram Jaccard join with prefix filters under several global token orders.

A document's set holds its distinct n-word shingles as 64-bit hashes. Equal sets are one node. Any two
sets over the threshold share a token among the first n - ceil(t n) + 1 under any global order, so

1. order one (rare first, by a count sketch over all documents; ties by hash) gives postings of prefixes
   a quarter longer, of which linked sets share several tokens; only tokens that two nodes or more hold
   stay, and only nodes left with that many of them; a pair needs one in the prefixes proper whose places
   leave room for the overlap;
2. candidates must share enough tokens of slightly longer prefixes under orders two and three as well
   (two hash permutations);
3. what passes all three is verified on the sets themselves.

Components need no link inside a component already known: nodes meet the most connected node of each
posting list first (three rounds), and then only pairs that still lie in different components are listed.
So a group of near copies costs about one comparison a member and round instead of one a pair; no
link between components is lost, for the last round lists every such pair that shares a token. The number
of links of every document, if asked for, is then counted within components, whose sets are compared in
blocks. Posting lists that may be long are dealt over several tasks in every step.

Nodes are 64-bit hashes of sets and tokens 64-bit hashes of shingles: among 10**6 different sets two share a
node with a probability of 3e-8, among 10**10 some two or three are expected to.

Defined results: null or empty texts, and those without words, have an empty set and stay alone;
shorter texts than n words are one shingle; repeated rows share their node; documents whose every copy
lacks an id take no part and stay alone (component null); an empty table gives an empty result; extra
columns are dropped.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.arrowmap import arrow_schema, batch_bytes, broadcast, no_broadcast_joins, trim
from weft.llm.common import drop, shuffle_width, spread, staged
from weft.llm.components import connected_components
from weft.llm.wordcut import MIX, mixed
from weft.session import ship

U = np.uint64
SKETCH_BITS = 24
SLICES = 32
#: Tokens counted 2**HOT times or more have their posting lists dealt over several tasks.
HOT = 8
#: Sets and shingles that a task holds at once when it counts links.
BLOCK_SETS, BLOCK_TOKENS = 256, 400_000


class Shingler:
    """Sets of shingle hashes of many texts at once. A word's hash is a polynomial over random values of
    its bytes, taken from sums over the whole batch; a shingle's mixes those of its words in order."""

    RATIO = 0xD1342543DE82EF95
    BATCH = 1 << 20

    def __init__(self, n: int):
        self.n = n
        random = np.random.default_rng(2024).integers(0, 1 << 64, 256, dtype=U)
        lower = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)])
        self.value, self.space = random[lower], np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
        self.power = self.inverse = np.ones(1, U)

    def _powers(self, size: int) -> None:
        if len(self.power) < size:
            size = max(size, 2 * self.BATCH)
            for name, r in (("power", self.RATIO), ("inverse", pow(self.RATIO, -1, 1 << 64))):
                setattr(self, name, np.concatenate([np.ones(1, U), np.full(size - 1, r, U).cumprod(dtype=U)]))

    def __call__(self, texts: list[str | None]):
        """The texts' sets, ascending, in turn."""
        held, size = [], 0
        for t in texts:
            held.append((t or "").encode("utf-8", "surrogatepass"))
            size += len(held[-1]) + 1
            if size >= self.BATCH:
                yield from self._batch(held)
                held, size = [], 0
        if held:
            yield from self._batch(held)

    def _batch(self, held: list[bytes]):
        raw = np.frombuffer(b"\n".join([b"", *held, b""]), np.uint8)
        self._powers(len(raw))
        space = self.space[raw]
        change = np.flatnonzero(space[1:] != space[:-1]) + 1
        start, end = change[::2], change[1::2]
        total = np.cumsum(self.value[raw] * self.power[: len(raw)], dtype=U)
        word = mixed((total[end - 1] - total[start - 1]) * self.inverse[start], 1)
        begin = np.cumsum([1] + [len(h) + 1 for h in held])
        cuts = np.searchsorted(start, begin)
        n = self.n
        full = np.full(max(0, len(word) - n + 1), n, U)
        for k in range(n if len(full) else 0):
            full = mixed(full * MIX[0] + word[k : k + len(full)], k + 2)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if b - a >= n:
                yield np.unique(full[a : b - n + 1])
            elif b > a:
                one = np.full(1, b - a, U)
                for k in range(a, b):
                    one = mixed(one * MIX[0] + word[k : k + 1], k - a + 2)
                yield one
            else:
                yield np.zeros(0, U)


def node_of(s: np.ndarray) -> int | None:
    """A set's node: a 64-bit hash of it; None for the empty set."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) if len(s) else None


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def signature(s: np.ndarray, percent: int) -> bytes:
    """Prefixes under orders two and three, a quarter longer than a shared token needs; 32 bits a token."""
    size = signature_size(len(s), percent)
    return b"".join(np.sort(np.partition(mixed(s, salt), size - 1)[:size] >> U(32)).astype("<u4").tobytes() for salt in (11, 12))


def signature_size(n: int, percent: int) -> int:
    p = prefix_size(n, percent)
    return min(n, p + p // 4)


def needed(n: int, percent: int) -> int:
    """Tokens that a set of n shares at least with a linked one within their first signature_size tokens
    under any order. Sets of n and m share a of them, so at least size - (n - a) of the first, and a is
    at least what prefix_size counts on; the smallest m that can be linked has the least to spare."""
    m = -(-percent * n // 100)
    return signature_size(m, percent) - prefix_size(m, percent) + 1


def may_link(x: np.ndarray, y: np.ndarray, n: int, m: int, percent: int) -> bool:
    """Whether signatures allow the threshold: sets of n and m tokens that share a of them share at least
    size - (n - a) of the first `size` under any order."""
    a, k, j = -(-percent * max(n, m) // 100), len(x) // 2, len(y) // 2
    need = min(k - n + a, j - m + a)
    for u, v in ((x[:k], y[:j]), (x[k:], y[j:])):
        both = np.concatenate([u, v])
        both.sort()
        if int((both[1:] == both[:-1]).sum()) < need:
            return False
    return True


def _rows(batch):
    for at in range(0, batch.num_rows, 256):
        part = batch.slice(at, 256)
        yield part.column(0).to_pylist(), part.column(1).to_pylist()


def profiles(docs: DataFrame, id: str, text: str, n: int) -> DataFrame:
    """A row for each document (id, node, n; null node for an empty set), and rows with a slice of a
    task's counts of all shingles by their top SKETCH_BITS bits, and the task."""
    ddl = "id long, node long, n int, slice int, counts binary, part int"
    schema = arrow_schema(ddl)

    def run(batches):
        sets, counts = Shingler(n), np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            for ids, texts in _rows(batch):
                nodes, sizes, seen = [], [], []
                for s in sets(texts):
                    seen.append(s >> U(64 - SKETCH_BITS))
                    nodes.append(node_of(s))
                    sizes.append(len(s))
                np.add.at(counts, np.concatenate(seen).astype(np.int64), np.uint32(1))
                none = [None] * len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((ids, nodes, sizes, none, none, none), schema)], schema=schema)
        trim()
        if counts.any():
            pack = zstandard.ZstdCompressor(level=1)
            for k, x in enumerate(np.split(counts, SLICES)):
                # The bytes of equal weight together: nearly all but the first are zeros.
                planes = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((None, None, None, k, pack.compress(planes), TaskContext.get().partitionId()), schema)], schema=schema)

    return docs.select(F.col(f"`{id}`").cast("long"), F.col(f"`{text}`").cast("string")).mapInArrow(run, ddl)


def frequency_levels(profiled: DataFrame) -> np.ndarray:
    """log2 of the summed counts, by the tokens' top bits; 2**SKETCH_BITS bytes at any input size. Where many
    tasks counted, about the root of their number are summed first, so no task gets a slice of each."""

    def total(pdf: pd.DataFrame) -> np.ndarray:
        out = np.zeros((1 << SKETCH_BITS) // SLICES, np.int64)
        for c in pdf["counts"]:
            planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(c), np.uint8).reshape(-1, len(out))
            out += np.ascontiguousarray(planes.T).view(f"<u{len(planes)}").ravel().astype(np.int64)
        return out

    def partial(pdf: pd.DataFrame) -> pd.DataFrame:
        planes = np.ascontiguousarray(total(pdf).astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()
        return pd.DataFrame({"slice": pdf["slice"][:1], "counts": [zstandard.ZstdCompressor(level=1).compress(planes)]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"slice": pdf["slice"][:1], "counts": [np.frexp(total(pdf))[1].astype("u1").tobytes()]})

    counted = profiled.filter("slice is not null").select("slice", "part", "counts")
    tasks = (counted.agg(F.max("part")).first()[0] or 0) + 1
    if tasks > 64:
        counted = counted.groupBy("slice", (F.col("part") % math.isqrt(tasks)).alias("k")).applyInPandas(partial, "slice int, counts binary")
    levels = np.zeros((SLICES, (1 << SKETCH_BITS) // SLICES), "u1")
    for r in counted.groupBy("slice").applyInPandas(add, "slice int, counts binary").collect():
        levels[r["slice"]] = np.frombuffer(r["counts"], "u1")
    trim()
    return levels.ravel()


def _has_partner(token: np.ndarray, n: np.ndarray, pos: np.ndarray, slack: np.ndarray, percent: int) -> np.ndarray:
    """Rows (by token, none of them hot) whose list holds another row that leaves room for the overlap, but for
    the `slack` tokens that may be shared before this one."""
    left, alive = n - pos, np.ones(len(token), bool)
    cuts = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(token))
    two = cuts[ends - cuts == 2]
    both, size = np.minimum(left[two], left[two + 1]), n[two] + n[two + 1]
    for k in (0, 1):
        alive[two + k] = (100 + percent) * (both + slack[two + k]) >= percent * size
    for a, b in zip(cuts.tolist(), ends.tolist()):
        if b - a > 2:
            ok = (100 + percent) * (np.minimum.outer(left[a:b], left[a:b]) + slack[a:b, None]) >= percent * np.add.outer(n[a:b], n[a:b])
            np.fill_diagonal(ok, False)
            alive[a:b] = ok.any(axis=1)
    return alive


def postings(docs: DataFrame, levels: Broadcast, text: str, n: int, percent: int, buckets: int) -> DataFrame:
    """(token, node, n, pos, need, proper) of the first signature_size tokens under order one that two nodes
    or more have; pos is the token's place in the node's order, need how many of them a linked node has,
    proper whether the place lies in the prefix of prefix_size tokens. The count sketch says which tokens may be
    hot (it never says too little): their lists go to several tasks by node and are judged in later rounds, and
    `salts` tells how many parts a list is to be dealt in; all other lists have less than 2**HOT rows."""
    entry = np.dtype([("token", "<u8"), ("node", "<i8"), ("n", "<i4"), ("pos", "<i4"), ("level", "u1")])
    ddl = "bucket int, entries binary"
    schema = arrow_schema(ddl)

    def emit(batches):
        sets, level, seen, held, size = Shingler(n), levels.value, set(), [], 0

        def flush():
            rows = np.concatenate(held)
            by_node = np.where(rows["level"] > HOT, mixed(rows["node"].astype(U), 6), U(0))
            bucket = (mixed(rows["token"] ^ by_node, 5) % U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            rows = rows[order]
            some = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
            return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([rows[cuts[b] : cuts[b + 1]].tobytes() for b in some], pa.binary())], schema=schema)

        for batch in batches:
            for _, texts in _rows(batch):
                for s in sets(texts):
                    if not len(s):
                        continue
                    node = node_of(s)
                    if node in seen:  # exact copies count once a task
                        continue
                    seen.add(node)
                    p = signature_size(len(s), percent)
                    own = level[(s >> U(64 - SKETCH_BITS)).astype(np.int64)]
                    key = (own.astype(U) << U(57)) | (mixed(s, 10) >> U(7))
                    rows = np.empty(p, entry)
                    few = np.argpartition(key, p - 1)[:p]
                    few = few[np.argsort(key[few])]
                    rows["token"], rows["node"], rows["n"], rows["pos"], rows["level"] = s[few], node, len(s), np.arange(p), own[few]
                    held.append(rows)
                    size += p
                    if size > 400_000:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()

    def runs(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = np.unique(np.frombuffer(b"".join(pdf["entries"]), entry))
        same = rows["token"][1:] == rows["token"][:-1]
        keep = np.zeros(len(rows), bool)
        keep[1:] |= same
        keep[:-1] |= same
        rows = rows[keep | (rows["level"] > HOT)]
        hot = rows["level"] > HOT
        sizes, of = np.unique(rows["n"].astype(np.int64), return_inverse=True)
        need = np.array([needed(int(x), percent) for x in sizes], np.int64)[of]
        proper = rows["pos"] < np.array([prefix_size(int(x), percent) for x in sizes], np.int64)[of]
        rich = hot.copy()
        rich[~hot] = _has_partner(rows["token"][~hot], rows["n"][~hot].astype(np.int64), rows["pos"][~hot], need[~hot] - 1, percent)
        rows, need, proper = rows[rich], need[rich], proper[rich]
        salts = 1 << np.minimum(np.maximum(rows["level"].astype(np.int64) - HOT, 0), 30)
        return pd.DataFrame({"token": np.ascontiguousarray(rows["token"]).view(np.int64), "node": rows["node"], "n": rows["n"], "pos": rows["pos"], "need": need.astype(np.int32), "proper": proper, "salts": salts.astype(np.int32)})

    few = docs.select(F.lit(0), F.col(f"`{text}`").cast("string")).mapInArrow(emit, ddl)
    return few.groupBy("bucket").applyInPandas(runs, "token long, node long, n int, pos int, need int, proper boolean, salts int")


def shingle_sets(docs: DataFrame, wanted: DataFrame, id: str, text: str, n: int, percent: int) -> DataFrame:
    """(node, n, sig, shingles) of the wanted (id, node) rows; twice where rows repeat."""
    ddl = "node long, n int, sig binary, shingles binary"
    schema = arrow_schema(ddl)

    def run(batches):
        sets = Shingler(n)
        for batch in batches:
            for nodes, texts in _rows(batch):
                rows = [(k, len(s), signature(s, percent), s.tobytes()) for k, s in zip(nodes, sets(texts)) if node_of(s) == k]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    rows = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.join(wanted, "id").select("node", "text").mapInArrow(run, ddl)


def _filtered(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that the prefixes under orders two and three allow."""
    schema = arrow_schema("a long, b long")

    def run(batches):
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(2, 6)]
            keep = [may_link(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4"), n, m, percent) for x, y, n, m in zip(*columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema=schema).filter(pa.array(keep, pa.bool_()))

    of = lambda end: sets.select(F.col("node").alias(end), F.col("sig").alias(f"sig_{end}"), F.col("n").alias(f"n_{end}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "sig_a", "sig_b", "n_a", "n_b").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    schema = arrow_schema("a long, b long")

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema=schema).filter(pa.array(keep, pa.bool_()))

    of = lambda end: sets.select(F.col("node").alias(end), F.col("shingles").alias(f"set_{end}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _salted(postings: DataFrame) -> DataFrame:
    """Postings with the part of their list that they are in."""
    return postings.withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int"))


def _everywhere(tokens: DataFrame) -> DataFrame:
    """Rows of tokens, one for each part of the token's list."""
    return tokens.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")


def _open(postings: DataFrame, by: str) -> DataFrame:
    """Postings of lists that hold two values of a column or more; no list has to be in one task."""
    some = postings.groupBy("token").agg(F.min(by).alias("lo"), F.max(by).alias("hi"), F.max("salts").alias("salts")).filter("lo <> hi").select("token", "salts")
    return _salted(postings).join(_everywhere(some), ["token", "salt"], "left_semi").drop("salt")


def _crossing(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of a with every set of b."""
    x, y = np.concatenate(a), np.concatenate(b)
    keys = np.intersect1d(x, y)
    out = np.zeros((len(a), len(b)))

    def places(tokens: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(keys, tokens)
        there = (at < len(keys)) & (keys[np.minimum(at, max(len(keys) - 1, 0))] == tokens) if len(keys) else np.zeros(len(tokens), bool)
        order = np.argsort(at[there], kind="stable")
        return at[there][order], np.repeat(np.arange(len(sets)), [len(s) for s in sets])[there][order]

    (p, i), (q, j) = places(x, a), places(y, b)
    for first in range(0, len(keys), 2048):  # so many shared shingles at a time
        m, n = np.zeros((len(a), 2048), "f4"), np.zeros((len(b), 2048), "f4")
        u, v = (slice(*np.searchsorted(z, [first, first + 2048])) for z in (p, q))
        m[i[u], p[u] - first], n[j[v], q[v] - first] = 1, 1
        out += m @ n.T
    return out


def _linked(a: list[np.ndarray], b: list[np.ndarray], percent: int) -> np.ndarray:
    common, na, nb = _crossing(a, b), np.array([len(s) for s in a]), np.array([len(s) for s in b])
    return 100 * common >= percent * (na[:, None] + nb[None, :] - common)


def link_counts(comp: DataFrame, sets: DataFrame, copies: DataFrame, percent: int) -> DataFrame:
    """(node, links): for every node of a component, how many documents have another set that it is linked
    with. Sets of a component are compared in blocks of bounded size, each pair of blocks in one step; nothing
    is emitted for pairs, and copies count by their number (copies: node, m)."""
    spark = comp.sparkSession
    one = sets.select("node", "n", "shingles").dropDuplicates(["node"])
    rows = comp.join(one, "node").join(copies, "node")
    size = rows.groupBy("comp").agg(F.count("*").alias("k"), F.sum("n").alias("tokens"))
    size = size.select("comp", F.greatest(F.ceil(F.col("k") / BLOCK_SETS), F.ceil(F.col("tokens") / BLOCK_TOKENS)).cast("int").alias("blocks"), "tokens")
    rows = staged(rows.join(size, "comp"), "component-sets")
    small = rows.filter("blocks = 1")
    groups = max(shuffle_width(spark), -(-(small.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) // 2_000_000))

    def within(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, some in pdf.groupby("comp", sort=False):
            s, m = [np.frombuffer(x, U) for x in some["shingles"]], some["m"].to_numpy()
            link = _linked(s, s, percent)
            np.fill_diagonal(link, False)
            out.append(pd.DataFrame({"node": some["node"], "links": link @ m}))
        return pd.concat(out)

    counted = small.groupBy(F.pmod(F.xxhash64("comp"), F.lit(groups)).alias("g")).applyInPandas(within, "node long, links long")
    large = rows.filter("blocks > 1").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    if large.isEmpty():
        return counted

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        body = b"".join(x.to_numpy().astype("<i8").tobytes() for x in (pdf["node"], pdf["m"], pdf["n"])) + b"".join(pdf["shingles"])
        return pd.DataFrame({"comp": pdf["comp"][:1], "block": pdf["block"][:1], "blocks": pdf["blocks"][:1], "k": [len(pdf)], "body": [zstandard.ZstdCompressor(level=3).compress(body)]})

    def unpack(k: int, body: bytes) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        data = zstandard.ZstdDecompressor().decompress(body)
        node, m, n = np.frombuffer(data, "<i8", 3 * k).reshape(3, k)
        return node, m, np.split(np.frombuffer(data, U, offset=24 * k), np.cumsum(n)[:-1])

    schema = arrow_schema("node long, links long")

    def between(batches):
        for batch in batches:
            for i, j, k, x, l, y in zip(*(batch.column(c) for c in range(6))):
                (an, am, a), (bn, bm, b) = unpack(k.as_py(), x.as_py()), unpack(l.as_py(), y.as_py())
                link = _linked(a, b, percent)
                if i == j:
                    np.fill_diagonal(link, False)
                    values = (an, link @ bm)
                else:
                    values = (np.concatenate([an, bn]), np.concatenate([link @ bm, am @ link]))
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)

    packed = staged(large.groupBy("comp", "block").applyInPandas(pack, "comp long, block int, blocks int, k int, body binary"), "component-blocks")
    left = packed.withColumn("other", F.explode(F.sequence("block", F.col("blocks") - 1))).withColumnsRenamed({"k": "ka", "body": "a"})
    right = packed.select("comp", F.col("block").alias("other"), F.col("k").alias("kb"), F.col("body").alias("b"))
    pairs = left.join(right, ["comp", "other"]).select("block", "other", "ka", "a", "kb", "b").repartition(max(shuffle_width(spark), 64))
    return counted.unionByName(pairs.mapInArrow(between, "node long, links long").groupBy("node").agg(F.sum("links").alias("links")))


def components(docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80, star_rounds: int = 3, links: bool = False) -> DataFrame:
    """One row for each document: id, n_shingles, component_id (the smallest id of its component) and, if asked
    for, n_links: the number of other documents with an id that it is linked with, copies included."""
    ship(docs.sparkSession)
    with batch_bytes(docs.sparkSession, 4 << 20), no_broadcast_joins(docs.sparkSession):
        return _components(spread(docs), id, text, n, percent, star_rounds, links)


def _components(docs: DataFrame, id: str, text: str, n: int, percent: int, star_rounds: int, count_links: bool) -> DataFrame:
    spark = docs.sparkSession
    profiled = staged(profiles(docs, id, text, n), "profiles")
    members = profiled.filter("slice is null").select("id", "node", "n")
    nodes = staged(profiled.filter("node is not null").groupBy("node", "n").agg(F.min("id").alias("id"), F.count("id").alias("m")), "nodes")
    entries = nodes.agg(F.coalesce(F.sum(F.col("n") * (100 - percent) / 80 + 1), F.lit(0.0))).first()[0]
    buckets = max(shuffle_width(spark), int(entries / 250_000) + 1)
    levels = broadcast(spark, frequency_levels(profiled))
    every = staged(postings(docs, levels, text, n, percent, buckets), "postings")
    levels.destroy()  # what is staged is not made again, and the driver holds a copy
    degree = staged(every.groupBy("node", "need").agg(F.count("*").alias("degree")).filter("degree >= need").select("node", "degree"), "degrees")
    posted = staged(_open(every.filter("proper").select("token", "node", "n", "pos", "salts").join(degree, "node"), "node"), "postings")
    drop(every, degree)
    degree = posted.select("node").distinct()
    sets = staged(shingle_sets(docs, degree.join(nodes.filter("id is not null"), "node").select("id", "node"), id, text, n, percent), "sets")
    # At the first token that two linked sets share, what is left of each holds the overlap they need.
    alike = (100 + percent) * F.least(F.col("n") - F.col("pos"), F.col("pn") - F.col("ppos")) >= percent * (F.col("n") + F.col("pn"))
    links, comp, ends = None, None, ("node", "n", "pos", "comp")
    for step in range(star_rounds + 1):
        if comp is None:
            here, known = posted.withColumn("comp", F.col("node")), None
        else:  # lists within one component are settled
            known = staged(posted.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "postings")
            here = staged(_open(known, "comp"), "postings")
        if step < star_rounds:
            order = F.struct(F.col("degree") if step == 0 else F.pmod(F.xxhash64("node", F.lit(step)), F.lit(1 << 20)), *ends)
            if step == 1:  # the most connected node outside the first pivot's component comes next
                best = F.max(F.struct("degree", *ends)).alias("p")
                first = here.groupBy("token").agg(best, F.max("salts").alias("salts")).select("token", "salts", F.col("p.comp").alias("known"))
                pivots = _salted(here).join(_everywhere(first), ["token", "salt"]).filter("comp <> known").groupBy("token").agg(best, F.max("salts").alias("salts"))
            else:
                pivots = here.groupBy("token").agg(F.max(order).alias("p"), F.max("salts").alias("salts"))
            pivots = staged(pivots.select("token", "salts", *[F.col(f"p.{c}").alias(a) for c, a in zip(ends, ("pivot", "pn", "ppos", "pcomp"))]), "pivots")
            found = _salted(here).join(_everywhere(pivots), ["token", "salt"]).filter((F.col("comp") != F.col("pcomp")) & alike)
        else:
            pivots = None
            other = here.select("token", "salts", *[F.col(c).alias(a) for c, a in zip(ends, ("pivot", "pn", "ppos", "pcomp"))])
            found = _salted(here).join(_everywhere(other), ["token", "salt"]).filter((F.col("node") < F.col("pivot")) & (F.col("comp") != F.col("pcomp")) & alike)
        pairs = staged(found.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct(), "pairs")
        passed = staged(_filtered(pairs, sets, percent), "candidates")
        new = staged(_verified(passed, sets, percent), "links")
        drop(known, here if comp is not None else None, pivots, pairs, passed)
        if comp is not None and new.isEmpty():  # components stay as they are
            drop(new)
            continue
        links = new if links is None else links.unionByName(new)
        before, comp = comp, connected_components(links)
        drop(before)
    drop(posted)
    named = nodes.join(comp, "node", "left").select("node", "id", "m", F.coalesce("comp", "node").alias("comp"))
    least = named.groupBy("comp").agg(F.min("id").alias("component_id"))
    of_node = named.join(least, "comp").select("node", "component_id", "m")
    if count_links:
        counted = link_counts(comp, sets, nodes.select("node", "m"), percent)
        of_node = of_node.join(counted, "node", "left").withColumn("links", F.col("m") - 1 + F.coalesce("links", F.lit(0)))
    of_node = staged(of_node, "components")
    drop(sets, comp, nodes)
    joined = members.join(of_node, "node", "left")
    n_links = [F.when(F.col("id").isNotNull(), F.coalesce("links", F.lit(0))).cast("long").alias("n_links")] if count_links else []
    return joined.select(F.col("id").alias(id), F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"), *n_links)
