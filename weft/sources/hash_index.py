"""A table of content hashes beside an append target, so that an append need not scan the target.

Generations lie below one folder, each written aside and then renamed into place, so a half-written one is
never seen. `g-<from>-<to>-<words>-<digits>` covers the appends <from> to <to>; its buckets are the hashes' first
<digits> digits, more of them the more hashes it has. It holds

  hashes/bucket=<first digits>/   the hashes, one folder a bucket
  bloom/bucket=<first digits>/    a Bloom filter of each bucket: (slot, bits), <words> slots of 64 bits; a hash sets
                                  four bits of the one slot that it falls in

A batch meets the Bloom filters of its own buckets first. What they let through is looked up exactly, in the
buckets of those hashes alone; buckets are named in the scans' partition filters. When there are more
generations than `merge_at`, they become one. If a number is missing from 0 to the last, or the folder is gone
while the target is there, the index is made anew from the target.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.operators.dedup import target_hashes
from weft.sources.readers import exists
from weft.sources.writers import _filesystem, _renamed
from weft.staging import drop, staged

#: Hashes for each slot of 64 bits of a Bloom filter, and for each bucket, on average, at most (of up to 16 ** 4 buckets).
PER_SLOT, PER_BUCKET, MOST_DIGITS = 4, 1_000_000, 4


@dataclass(frozen=True)
class Generation:
    """A folder with the hashes of the appends first to last, the slots of each of its Bloom filters, and the digits
    that name a bucket."""

    path: str
    first: int
    last: int
    words: int
    digits: int


def _bucket(digits: int) -> Column:
    return F.left("hash", F.lit(digits))


def _slot(words: int) -> Column:
    return F.xxhash64("hash").bitwiseAND(F.lit(words - 1))


def _bits() -> Column:
    """Four bits of 64, from a hash that does not choose the slot."""
    one = "shiftleft(1L, cast(shiftright(xxhash64(hash, 'bits'), {}) & 63L as int))"
    return F.expr(" | ".join(one.format(6 * k) for k in range(4)))


class HashIndex:
    """The hashes of a table. `digits` sets those of new generations; by default their size does."""

    def __init__(self, spark: SparkSession, path: str, digits: int | None = None, merge_at: int = 8):
        self.spark, self.path, self.digits, self.merge_at = spark, path.rstrip("/"), digits, merge_at

    def generations(self) -> list[Generation]:
        """In order; those that a merged one covers are left out."""
        if not exists(self.spark, self.path):
            return []
        fs, root = _filesystem(self.spark, self.path)
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        found = sorted((int(a), -int(b), int(w), int(d), n) for n in names if n.startswith("g-") for _, a, b, w, d in [n.split("-")])
        out: list[Generation] = []
        for first, last, words, digits, name in found:
            if not out or -last > out[-1].last:
                out.append(Generation(f"{self.path}/{name}", first, -last, words, digits))
        return out

    def whole(self) -> bool:
        """Whether there are generations and none between the first append and the last is missing."""
        gens = self.generations()
        return bool(gens) and gens[0].first == 0 and all(a.last + 1 == b.first for a, b in zip(gens, gens[1:]))

    def _write(self, hashes: DataFrame, first: int, last: int) -> None:
        """A generation of distinct hashes, put into place by a rename."""
        hashes = staged(hashes.select("hash").distinct(), "hashes")
        n, words, digits = hashes.count(), 1, self.digits or 1
        while self.digits is None and digits < MOST_DIGITS and 16**digits * PER_BUCKET < n:
            digits += 1
        while words * PER_SLOT * 16**digits < n:
            words *= 2
        aside = f"{self.path}/.writing-{first}-{last}"
        fs, at = _filesystem(self.spark, aside)
        fs.delete(at, True)
        keyed = hashes.withColumn("bucket", _bucket(digits))
        keyed.repartition("bucket").sortWithinPartitions("bucket", "hash").write.partitionBy("bucket").parquet(f"{aside}/hashes")
        bloom = keyed.groupBy("bucket", _slot(words).alias("slot")).agg(F.bit_or(_bits()).alias("bits"))
        bloom.repartition("bucket").sortWithinPartitions("bucket", "slot").write.partitionBy("bucket").parquet(f"{aside}/bloom")
        _renamed(fs, at, _filesystem(self.spark, f"{self.path}/g-{first}-{last}-{words}-{digits}")[1])
        drop(hashes)

    def add(self, hashes: DataFrame) -> None:
        """The column `hash` of an append becomes a generation."""
        gens = self.generations()
        at = gens[-1].last + 1 if gens else 0
        self._write(hashes, at, at)
        if len(gens) + 1 > self.merge_at:
            self.merge()

    def merge(self) -> None:
        """One generation of all. The old ones go last: until then they are covered by the new one."""
        old = self.generations()
        self._write(self._read("hashes", old, None), old[0].first, old[-1].last)
        fs, _ = _filesystem(self.spark, self.path)
        for g in old:
            if (g.first, g.last) != (old[0].first, old[-1].last):
                fs.delete(_filesystem(self.spark, g.path)[1], True)

    def rebuild(self, target: DataFrame | None) -> None:
        """The index of what a target holds."""
        fs, root = _filesystem(self.spark, self.path)
        fs.delete(root, True)
        if target is not None:
            self._write(target_hashes(target).select(F.col("_hash").alias("hash")), 0, 0)

    def _read(self, part: str, gens: list[Generation], buckets: list[str] | None) -> DataFrame:
        """Rows of a part of some generations with `gen`, of the buckets of some hashes' first digits only."""
        schema = {"hashes": "hash string, bucket string", "bloom": "slot long, bits long, bucket string"}[part]
        each = []
        for k, g in enumerate(gens):
            rows = self.spark.read.schema(schema).parquet(f"{g.path}/{part}").withColumn("gen", F.lit(k))
            each.append(rows if buckets is None else rows.filter(F.col("bucket").isin(sorted({b[: g.digits] for b in buckets}))))
        return reduce(DataFrame.unionByName, each)

    def maybe(self, hashes: DataFrame) -> DataFrame:
        """(hash, gen) of distinct hashes that a generation's Bloom filters let through."""
        gens, known = self.generations(), hashes.select("hash").distinct()
        bloom = self._read("bloom", gens, self._buckets(known, gens))
        places = [F.struct(F.lit(k).alias("gen"), _slot(g.words).alias("slot"), _bucket(g.digits).alias("bucket")) for k, g in enumerate(gens)]
        tried = known.select("hash", F.explode(F.array(*places)).alias("t")).select("hash", "t.*")
        met = tried.join(bloom, ["gen", "bucket", "slot"])
        return met.filter(F.col("bits").bitwiseAND(_bits()) == _bits()).select("hash", "gen", "bucket")

    def seen(self, hashes: DataFrame) -> DataFrame:
        """The distinct hashes of a column `hash` that the index holds."""
        gens = self.generations()
        if not gens:
            return hashes.select("hash").limit(0)
        likely = staged(self.maybe(hashes), "likely")
        exact = self._read("hashes", gens, self._buckets(likely, gens))
        return likely.join(exact, ["gen", "bucket", "hash"], "left_semi").select("hash").distinct()

    @staticmethod
    def _buckets(hashes: DataFrame, gens: list[Generation]) -> list[str]:
        """The first digits of a batch's hashes, as many as the finest buckets have: at most 16 ** MOST_DIGITS."""
        return [r["b"] for r in hashes.select(_bucket(max(g.digits for g in gens)).alias("b")).distinct().collect()]
