"""URL filters: host and path rules first, then the ratio of two character language models.

Both models, of accepted and of rejected URLs, are variable-order Markov models over the bytes of the URL
with A-Z lower-cased. The chance of a byte after its last k bytes is its count there plus WEIGHT times its
chance after the last k - 1, over the context's count plus WEIGHT: long contexts decide where they were
seen often, shorter ones elsewhere. A URL's score is the mean over its bytes and its end of the difference
of the log-likelihoods; the threshold is the score that parts labelled URLs best which training left out.

Counts are taken over all labelled rows, by Spark, in hashed slots: (order, slot) rows, summed before and
after the shuffle, of which at most ORDERS * 2 ** BITS exist at any size of input.

Defined results: a null URL and one without `://` have an empty host and path, which no rule fits; a null or
empty URL has score 0 and is allowed unless the threshold is above 0; without labelled rows of both kinds
every score is 0 and every URL without a rule is allowed; repeated rows and null ids each get a row; an
empty table gives an empty result; result names win over equally named columns. URLs are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.llm.arrowmap import arrow_schema, broadcast, map_text
from weft.session import ship

ORDERS, BITS, WEIGHT = 6, 17, 4.0
#: Bytes before and after a URL.
START, END = 2, 3
#: Rows with this remainder of a hash of the URL modulo HELD are left to calibration.
HELD = 5
#: Calibration bins for each unit of the score, and the largest score that has bins of its own.
FINE, MOST = 64, 16
#: Bytes whose places are worked on at once.
PIECE = 1 << 18
#: The multipliers of the mixing function.
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains, a prefix of the path, and whether such URLs are allowed."""

    host: str
    path: str
    allow: bool


def host_of(url: Column) -> Column:
    """What stands after the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Iterable[Rule]) -> Column:
    """The longest fitting rule as a struct (rule, allow), null if none fits."""
    fit = [
        F.when((host == r.host) | F.endswith(host, F.lit(f".{r.host}")), F.when(F.startswith(path, F.lit(r.path)), F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.allow).alias("allow"))))
        for r in sorted(rules, key=lambda r: (-len(r.host + r.path), r.host + r.path))
    ]
    return F.coalesce(*fit) if fit else F.lit(None).cast("struct<rule:string,allow:boolean>")


def grams(text: np.ndarray) -> list[np.ndarray]:
    """For k from 0 to ORDERS - 1 the slot of the k + 1 bytes that end at each place."""
    out, h = [], np.zeros(len(text), np.uint64)
    for _ in range(ORDERS):
        h = np.concatenate([h[:1], h[:-1]]) * np.uint64(MIX[0]) + text + np.uint64(1)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(MIX[1])
        out.append((h >> np.uint64(64 - BITS)).astype(np.int64))
    return out


def pieces(urls: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]]:
    """The URLs' bytes in order, each between ORDERS starts and an end, in pieces: (row, place in the URL, slots
    by order, slots of the grams before the byte by order). What the first ORDERS - 1 places of a URL give is
    of no use."""
    raw = [b"" if u is None else u.encode("utf-8", "surrogatepass").translate(LOWER) for u in urls]
    text = np.frombuffer(b"".join(bytes([START]) * ORDERS + r + bytes([END]) for r in raw), np.uint8)
    sizes = np.array([ORDERS + len(r) + 1 for r in raw], np.int64)
    row, at = np.repeat(np.arange(len(raw)), sizes), np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    for first in range(0, len(text), PIECE):
        before = min(first, ORDERS)
        whole = grams(text[first - before : first + PIECE].astype(np.uint64))
        earlier = [np.concatenate([g[:1], g[:-1]])[before:] for g in whole]
        yield row[first : first + PIECE], at[first : first + PIECE], [g[before:] for g in whole], earlier


class UrlModel:
    """Log-likelihood ratios from counts[label, order, slot], label 1 for accepted URLs."""

    def __init__(self, counts: np.ndarray):
        self.counts, self.threshold = counts, 0.0
        self.totals = counts[:, 0].sum(axis=1)

    @property
    def known(self) -> bool:
        return bool((self.totals > 0).all())

    def scores(self, urls: list[str | None]) -> np.ndarray:
        """Mean log-likelihood ratio of each URL, accepted over rejected."""
        total, sizes = np.zeros(len(urls)), np.zeros(len(urls))
        some = np.array([bool(u) for u in urls], bool)
        for row, at, slots, earlier in pieces(urls) if self.known else ():
            real = np.flatnonzero((at >= ORDERS) & some[row])
            logs = []
            for c, n in zip(self.counts, self.totals):
                p = (c[0][slots[0]] + 1.0) / (n + 256.0)
                for k in range(1, ORDERS):
                    seen, context = c[k][slots[k]], c[k - 1][earlier[k - 1]]
                    p = (seen + WEIGHT * p) / (np.maximum(context, seen) + WEIGHT)  # slots may hold several grams
                logs.append(np.log(p))
            total += np.bincount(row[real], (logs[1] - logs[0])[real], len(urls))
            sizes += np.bincount(row[real], minlength=len(urls))
        return total / np.maximum(sizes, 1)


def _counted(labelled: DataFrame) -> np.ndarray:
    """counts[label, order, slot] of (url, accepted)."""
    schema = arrow_schema("label int, place int, n long")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, ORDERS << BITS), np.int64)
        for batch in batches:
            for first in range(0, batch.num_rows, 2048):
                part = batch.slice(first, 2048)
                label = np.array(part.column(1).to_pylist(), np.int64)
                for row, at, slots, _ in pieces(part.column(0).to_pylist()):
                    for k, slot in enumerate(slots):
                        for c in (0, 1):
                            # From the last start on: a context is the gram before its byte.
                            own = slot[(at >= ORDERS - 1) & (label[row] == c)]
                            held[c, k << BITS : (k + 1) << BITS] += np.bincount(own, minlength=1 << BITS)
        for c in (0, 1):
            some = np.flatnonzero(held[c])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), c, "i4")), pa.array(some.astype("i4")), pa.array(held[c][some])], schema=schema)

    rows = labelled.mapInArrow(count, "label int, place int, n long").groupBy("label", "place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((2, ORDERS << BITS))
    out[rows.column("label").to_numpy(), rows.column("place").to_numpy()] = rows.column("n").to_numpy()
    return out.reshape(2, ORDERS, 1 << BITS).astype("f4")


def best_threshold(bins: dict[tuple[int, bool], int]) -> float:
    """The edge between bins (place, accepted) at which the shares of accepted URLs below and of rejected
    ones above are least together; the middle of the edges that do equally well."""
    good, bad = (sum(n for (_, a), n in bins.items() if a is kind) for kind in (True, False))
    if not good or not bad:
        return 0.0
    places = sorted({b for b, _ in bins})
    below = above = 0
    edges = [(bad * good, places[0], places[0])]  # an error, and the range of edges that have it: here nothing is lost, all rejected ones pass
    for b, after in zip(places, [*places[1:], places[-1] + 1]):
        below += bins.get((b, True), 0)
        above += bins.get((b, False), 0)
        edges.append((below * bad + (bad - above) * good, b + 1, after))
    least = min(edges)[0]
    equal = [e for e in edges if e[0] == least]
    return (equal[0][1] + equal[-1][2]) / 2 / FINE


def train(labelled: DataFrame, url: str = "url", accepted: str = "accepted") -> UrlModel:
    """A model of all rows with a URL and a label, but for those in HELD that the threshold is taken from."""
    spark = labelled.sparkSession
    ship(spark)
    rows = labelled.select(F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{accepted}`").cast("int").alias("accepted")).dropna()
    left_out = F.pmod(F.xxhash64("url"), F.lit(HELD)) == 0
    model = UrlModel(_counted(rows.filter(~left_out)))
    if model.known:
        shared = broadcast(spark, model)
        scored = map_text(rows.filter(left_out), ["accepted"], "score double", lambda: lambda urls: [shared.value.scores(urls)], "url")
        bins = scored.groupBy(F.floor(F.least(F.greatest(F.col("score"), F.lit(-float(MOST))), F.lit(float(MOST))) * FINE).cast("int").alias("b"), "accepted").count().collect()
        model.threshold = best_threshold({(r["b"], bool(r["accepted"])): r["count"] for r in bins})
        shared.unpersist()
    return model


def judge(pages: DataFrame, model: UrlModel, rules: Iterable[Rule], keep: list[str], url: str = "url") -> DataFrame:
    """The kept columns, host, path, score, rule and verdict (allow or block) of every row: the longest
    fitting rule decides, and the model where none fits."""
    shared = broadcast(pages.sparkSession, model)
    rules, names = list(rules), ("host", "path", "score", "rule", "verdict")
    kept = [c for c in keep if c not in names]
    own = F.col(f"`{url}`").cast("string")
    parts = pages.select(*[F.col(f"`{c}`") for c in kept], host_of(own).alias("host"), path_of(own).alias("path"), own.alias("_url"))
    scored = map_text(parts, [*kept, "host", "path"], "score double", lambda: lambda urls: [shared.value.scores(urls)], "_url")
    ruled = scored.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    allowed = F.coalesce(F.col("_rule.allow"), F.col("score") >= model.threshold)
    return ruled.select(*[F.col(f"`{c}`") for c in kept], "host", "path", F.col("_rule.rule").alias("rule"), F.when(allowed, "allow").otherwise("block").alias("verdict"), "score")


def ruled_urls(pages: DataFrame, rules: Iterable[Rule], url: str = "url") -> DataFrame:
    """(url, accepted) of the rows that a rule decides: labels that come with the rules."""
    own = F.col(f"`{url}`").cast("string")
    return pages.select(own.alias("url"), rule_of(host_of(own), path_of(own), list(rules))["allow"].alias("accepted")).filter("accepted is not null")
