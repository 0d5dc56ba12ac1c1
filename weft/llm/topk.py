"""Exact top-k inner products with KD-trees per shard.

Components become floor(256 * x), kept as doubles, which hold every such integer exactly. Candidates are
dealt to shards by a hash of the id and queries to blocks, and each pair of a shard and a block is one
task's work: a KD-tree by median splits with tight bounding boxes; for a query, nodes are taken best first
by the largest inner product that their box allows, until that is below the kth score found so far. Every
query first searches one shard, its own; the kth score found there goes with it to all others, which
give up below it from the start.

Scores are exact integers at any size: doubles where they are exact, Python's integers elsewhere. A score
beyond 64 bits is ranked by its exact value and reported as the nearest of -(2**63 - 1) and 2**63 - 1.

Defined results: vectors that are null, empty, or hold a null or non-finite component (or a
finite one whose 256-fold is beyond doubles) take no part; a
query meets only vectors of its own length; rows that bear the query's id are its own and never its
results; ids that repeat among queries count once (the smallest vector), repeated candidate rows each
count; null ids take no part; an empty table gives an empty result; extra columns are dropped.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.llm.common import staged
from weft.session import ship


LARGEST = (1 << 63) - 1


class KDTree:
    """Arrays of a KD-tree: node -> rows [begin, end) of `order`, children, box."""

    def __init__(self, points: np.ndarray, leaf: int = 128):
        self.points, self.order = points, np.arange(len(points))
        self.begin, self.end, self.left, self.low, self.high = [], [], [], [], []
        self._node(0, len(points))
        at = 0
        while at < len(self.begin):
            b, e = self.begin[at], self.end[at]
            spread = self.high[at] - self.low[at]
            if e - b > leaf and spread.max() > 0:
                axis, middle = int(spread.argmax()), (b + e) // 2
                rows = self.order[b:e]
                self.order[b:e] = rows[np.argpartition(points[rows, axis], middle - b)]
                self.left[at] = len(self.begin)
                self._node(b, middle)
                self._node(middle, e)
            at += 1
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.sorted = points[self.order]

    def _node(self, b: int, e: int) -> None:
        rows = self.points[self.order[b:e]]
        self.begin.append(b)
        self.end.append(e)
        self.left.append(-1)
        self.low.append(rows.min(axis=0))
        self.high.append(rows.max(axis=0))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest inner product of each query with any point of each node's box."""
        zero = np.zeros_like(queries)
        return np.maximum(queries, zero) @ self.high.T + np.minimum(queries, zero) @ self.low.T

    def search(self, query: np.ndarray, bound: np.ndarray, ids: np.ndarray, own: int, k: int, least=None) -> list[tuple]:
        """The k best (score, -id) pairs of at least the score `least`, best first; ids are those of `order`."""
        best: list[tuple] = []
        heap = [(-bound[0], 0)]
        while heap:
            upper, node = heapq.heappop(heap)
            floor = best[0][0] if len(best) == k else least
            if floor is not None and -upper < floor:
                break
            if self.left[node] >= 0:
                for child in (self.left[node], self.left[node] + 1):
                    if floor is None or bound[child] >= floor:
                        heapq.heappush(heap, (-bound[child], child))
                continue
            b, e = self.begin[node], self.end[node]
            scores = self.sorted[b:e] @ query
            if floor is not None:
                few = np.flatnonzero(scores >= floor)
            elif e - b > 4 * k:
                # k rows besides the query's own: the kth largest of these scores, ties included.
                others = scores[ids[b:e] != own]
                few = np.flatnonzero(scores >= np.partition(others, -k)[-k]) if len(others) >= k else np.arange(e - b)
            else:
                few = np.arange(e - b)
            for i in few.tolist():
                if ids[b + i] != own:
                    item = (scores[i], -int(ids[b + i]))
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
        return sorted(best, reverse=True)


def place_of(score: int) -> str:
    """A string that sorts as the exact scores do among those that are reported as the same number."""
    if abs(score) <= LARGEST:
        return "5"
    digits = str(abs(score))
    return f"9{len(digits):04d}{digits}" if score > 0 else f"1{9999 - len(digits):04d}" + "".join(str(9 - int(c)) for c in digits)


FOUND = "query_id long, vec_id long, score long, place string"


def top_k(vectors: DataFrame, is_query, k: int = 5, id: str = "vec_id", vector: str = "embedding", shard_rows: int = 16_384, block_queries: int = 4096, leaf: int = 128) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best candidates of each row that the column
    `is_query` selects; ties go to the smaller id."""
    spark = vectors.sparkSession
    ship(spark)
    scaled = lambda x: x.cast("double") * 256
    finite = F.forall(f"`{vector}`", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(scaled(x)) < float("inf")))
    fit = F.col(f"`{vector}`").isNotNull() & (F.size(f"`{vector}`") > 0) & finite & F.col(f"`{id}`").isNotNull()
    whole = lambda x: F.when(F.abs(scaled(x)) < 2.0**62, F.floor(scaled(x)).cast("double")).otherwise(scaled(x))
    rows = vectors.filter(fit).select(F.col(f"`{id}`").cast("long").alias("id"), F.transform(f"`{vector}`", whole).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = staged(rows.withColumn("dim", F.size("v")), "topk-vectors")
    n, m = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("q").cast("int")), F.lit(0))).first()
    shards, blocks = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(m / block_queries))
    over = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    located = rows.select("dim", "id", "v", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int").alias("shard"))
    asked = rows.filter("q").groupBy("id", "dim").agg(F.min("v").alias("v")).groupBy("id").agg(F.min(F.struct("dim", "v")).alias("x"))
    asked = asked.select("x.dim", "id", "x.v", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("own_shard"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"))

    def search(have: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if have.empty or ask.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "place": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "int64", "place": "object"})
        points, wanted = np.stack(have["v"].to_numpy()), np.stack(ask["v"].to_numpy())
        # Doubles are exact below 2**53; beyond it Python's integers are.
        if float(np.abs(points).max()) * float(np.abs(wanted).max()) * points.shape[1] >= 1 << 53:
            points, wanted = (np.array([[int(x) for x in row] for row in a], object) for a in (points, wanted))
        tree = KDTree(points, leaf)
        ids = have["id"].to_numpy()[tree.order]
        bounds, out = tree.bounds(wanted), []
        for own, q, b, least in zip(ask["id"].tolist(), wanted, bounds, ask["least"].tolist()):
            for s, i in tree.search(q, b, ids, own, k, None if least is None or least != least else int(least)):
                out.append((own, -i, max(-LARGEST, min(LARGEST, int(s))), place_of(int(s))))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score", "place"])

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("place"), "vec_id")
    best = lambda found: found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    none = F.lit(None).cast("string").alias("least")
    if shards == 1:
        keys = ["dim", "block"]
        found = located.select("dim", "id", "v", over(blocks).alias("block")).groupBy(*keys).cogroup(asked.select("dim", "id", "v", "block", none).groupBy(*keys)).applyInPandas(search, FOUND)
        return best(found).select("query_id", "rank", "vec_id", "score")
    asked = staged(asked, "topk-queries")
    keys = ["dim", "shard"]
    first = located.groupBy(*keys).cogroup(asked.select("dim", "id", "v", F.col("own_shard").alias("shard"), none).groupBy(*keys)).applyInPandas(search, FOUND)
    first = staged(best(first), "topk-first")
    # The kth score of the own shard; a reported score that stands for smaller ones is no bound. As a string,
    # for pandas would make doubles of numbers beside nulls.
    bound = first.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.when(F.col("score") > -LARGEST, F.col("score").cast("string")).alias("least"))
    keys = ["dim", "shard", "block"]
    rest = asked.join(bound, "id", "left").select("dim", "id", "v", "block", "least", "own_shard", over(shards).alias("shard")).filter("shard <> own_shard").drop("own_shard")
    others = located.select("dim", "id", "v", "shard", over(blocks).alias("block")).groupBy(*keys).cogroup(rest.groupBy(*keys)).applyInPandas(search, FOUND)
    return best(others.unionByName(first.drop("rank"))).select("query_id", "rank", "vec_id", "score")
