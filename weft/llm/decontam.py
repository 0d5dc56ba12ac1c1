"""Benchmark decontamination by spaced-seed hashing, in DataFrame and SQL functions only.

Words are runs of letters and digits, lower-cased. At every position each fixed mask hashes the words at
its ones and ignores those at its zeros. Training and benchmark hashes are joined; a hit of a document and
an item names a diagonal (document place less item place), along which all their words are compared: an
overlap is the stretch of the diagonal with the most equal words in which they are enough and few words
lie between them, so substituted words cost only themselves and matches far off on the diagonal cost
nothing. Only a diagonal without any hit is not looked at. Positions whose hash no benchmark item can have are dropped
before the join by a bit table of the benchmark hashes; what the table lets through by chance the join
drops.

Defined results: null and empty texts and items give nothing; rows that repeat an id and a text count
once, a repeated id with other texts once for each; of an item's repeated ids the best text counts; null ids are kept as ids of their own; empty tables
give an empty result; extra columns are ignored. An item shorter than `min_words` must be met whole; one shorter
than the masks is looked for by a hash of all its words, at the places where its first word stands.
"""

from __future__ import annotations

import uuid
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import staged

#: The masks' ones, as word places from their start. Together they meet every overlap in which at
#: least 60 % of the words are equal by a pattern that repeats after 8 words or fewer.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 3, 5, 6), (0, 2, 3, 4, 6), (0, 1, 3, 4, 6), (0, 1, 2, 3, 7), (0, 3, 4, 5, 8))
#: Places that are ones in every mask: the pair at them is tested first.
PAIR = (0, 3)


def hashes_sql(text: str) -> str:
    """SQL of the array of the 64-bit hashes of a text column's words."""
    words = f"array_remove(split(lower(coalesce(cast(`{text}` as string), '')), '[^\\\\p{{L}}\\\\p{{N}}]+'), '')"
    return f"transform({words}, w -> xxhash64(w))"


def _seed(m: int) -> str:
    """SQL of the hash of mask m at place i of the array _h."""
    return f"xxhash64({m}, " + ", ".join(f"_h[i + {p}]" for p in MASKS[m]) + ")"


def _pair(i: str) -> str:
    """SQL of a hash of the two words at place i of the array _h that every mask keeps."""
    return f"(_h[{i} + {PAIR[0]}] ^ shiftleft(_h[{i} + {PAIR[1]}], 1))"


def _in_table(table: str, value: str, bits: int) -> str:
    """SQL: the bit of a value is set in a table of a power of two of bits, 64 a word."""
    return f"(shiftright({table}[cast(shiftright({value} & {bits - 1}L, 6) as int)], cast({value} & 63L as int)) & 1L) = 1L"


def _bit_table(known: DataFrame, column: str, bits: int) -> str:
    """SQL of the words of a bit table: a subquery on a staged row of bits / 64 words, whatever the benchmark's size.
    As a literal they would stand in every text of the plan that the driver makes and keeps."""
    b = F.col(column).bitwiseAND(F.lit(bits - 1))
    slots = known.select(b.alias("b")).groupBy(F.shiftright("b", 6).alias("slot")).agg(F.expr("bit_or(shiftleft(1L, cast(b & 63L as int)))").alias("word"))
    every = known.sparkSession.range(bits // 64).withColumnRenamed("id", "slot").join(slots, "slot", "left").select("slot", F.coalesce("word", F.lit(0)).alias("word"))
    words = every.agg(F.array_sort(F.collect_list(F.struct("slot", "word"))).alias("of")).select(F.transform("of", lambda x: x["word"]).alias("words"))
    view = f"weft_bits_{uuid.uuid4().hex}"
    staged(words, "bits").createTempView(view)
    return f"(SELECT words FROM {view})"


def _forget(df: DataFrame, *tables: str) -> DataFrame:
    """df, whose plan has read the views of some tables by now, which go."""
    for t in tables:
        df.sparkSession.catalog.dropTempView(t.removeprefix("(SELECT words FROM ").removesuffix(")"))
    return df


def _found(docs: DataFrame, own: tuple, text: str, found: str, first: str, seed: str) -> DataFrame:
    """(_id, _text_hash, at, seed) of what an expression on a document's word hashes _h and the tables _t.first and
    _t.seed finds. Tables and hashes are used once, so that the optimizer puts them into the one place that reads
    them, and no row holds a table."""
    named = docs.select(*own, F.col(f"`{text}`").alias("_text"), F.expr(first).alias("_first"), F.expr(seed).alias("_seed"))
    tables = "array(named_struct('first', _first, 'seed', _seed))"
    all_found = named.select("_id", "_text_hash", F.expr(f"transform({tables}, _t -> transform(array({hashes_sql('_text')}), _h -> {found})[0])[0]").alias("_found"))
    # explode() would have the optimizer evaluate the array a second time, in a filter on its size.
    return _forget(all_found, first, seed).select("_id", "_text_hash", F.explode_outer("_found").alias("x")).filter("x is not null").select("_id", "_text_hash", "x.*")


def _places(m: int) -> str:
    last = max(MASKS[m])
    return f"if(size(_h) > {last}, sequence(0, size(_h) - {last + 1}), cast(array() as array<int>))"


def benchmark_words(benchmark: DataFrame, id: str, text: str) -> DataFrame:
    """(_item, item, _words: the word hashes) of every benchmark item with words, repeated ones once."""
    words = benchmark.select(F.col(f"`{id}`").alias("item"), F.expr(hashes_sql(text)).alias("_words")).distinct()
    return words.filter("size(_words) > 0").select(F.monotonically_increasing_id().alias("_item"), "item", "_words")


#: Words of the shortest item that a mask fits.
SHORTEST = min(max(m) for m in MASKS) + 1
#: Words of a block over which running least and greatest values are taken.
BLOCK = 128


def short_seeds(items: DataFrame) -> DataFrame:
    """(_item, n_words, seed of all words, first word) of the items that no mask fits."""
    whole = f"case size(_words) {' '.join(f'when {n} then {_whole(n, "_words", "0")}' for n in range(1, SHORTEST))} end"
    return items.filter(F.size("_words") < SHORTEST).select("_item", F.size("_words").alias("n_words"), F.expr(whole).alias("seed"), F.col("_words")[0].alias("first"))


def _whole(n: int, words: str, i: str) -> str:
    """SQL of the hash of the n words from place i of an array."""
    return f"xxhash64(-{n}, " + ", ".join(f"{words}[{i} + {k}]" for k in range(n)) + ")"


def seeds(items: DataFrame) -> DataFrame:
    """(_item, mask, place, n_words of the item, seed, pair) of every item of benchmark_words."""
    arrays = ", ".join(f"transform({_places(m)}, i -> named_struct('mask', {m}, 'place', i, 'n_words', size(_h), 'seed', {_seed(m)}, 'pair', {_pair('i')}))" for m in range(len(MASKS)))
    all_seeds = F.expr(f"transform(array(_words), _h -> concat({arrays}))[0]")
    return items.select("_item", F.explode_outer(all_seeds).alias("s")).filter("s is not null").select("_item", "s.*")


def _most(places: str, min_share: float) -> str:
    """SQL of the most places, of an ascending array of some, in a stretch of which they make up at least
    min_share: with v = places so far less share times place, first and last place of such a stretch
    differ by share - 1 at least in v. The least v before and the greatest after each place allow to find
    the longest stretch with both ends moving to the right only."""
    share = Fraction(str(min_share)).limit_denominator(1_000_000)
    num, den = share.numerator, share.denominator
    value = f"transform({places}, (p, k) -> {den}L * k - {num}L * p)"
    # Extremes of whole blocks first: a place then looks at the blocks' and at its own block only.
    blocks = f"transform(sequence(0, (size(v) - 1) div {BLOCK}), b -> named_struct('lo', array_min(slice(v, {BLOCK} * b + 1, {BLOCK})), 'hi', array_max(slice(v, {BLOCK} * b + 1, {BLOCK}))))"
    upto = "transform(blocks, (x, b) -> named_struct('lo', array_min(transform(slice(blocks, 1, b), y -> y.lo)), 'hi', array_max(transform(slice(blocks, b + 2, size(blocks)), y -> y.hi))))"
    least = f"transform(v, (x, k) -> least(ends[k div {BLOCK}].lo, array_min(slice(v, {BLOCK} * (k div {BLOCK}) + 1, k % {BLOCK} + 1))))"
    greatest = f"transform(v, (x, k) -> greatest(ends[k div {BLOCK}].hi, array_max(slice(v, k + 1, {BLOCK} - k % {BLOCK}))))"
    bounds = f"transform(array({blocks}), blocks -> transform(array({upto}), ends -> named_struct('lo', {least}, 'hi', {greatest}))[0])[0]"
    fits = f"z.j < size(v) and b.hi[z.j] - b.lo[z.i] >= {num - den}L"
    walk = f"""aggregate(sequence(1, 2 * size(v)), named_struct('i', 0, 'j', 0, 'best', 0),
        (z, step) -> if({fits}, named_struct('i', z.i, 'j', z.j + 1, 'best', greatest(z.best, z.j + 1 - z.i)), if(z.j < size(v), named_struct('i', z.i + 1, 'j', z.j, 'best', z.best), z)), z -> z.best)"""
    walked = f"transform(array({bounds}), b -> {walk})[0]"
    return f"transform(array({value}), v -> if(v[size(v) - 1] - v[0] >= {num - den}L, size(v), {walked}))[0]"


def _with_short(met: DataFrame, docs: DataFrame, own: tuple, text: str, known: DataFrame, max_bits: int, broadcast_rows: int) -> DataFrame:
    """The diagonals met, and those of the short items: none are looked for if there are none."""
    lengths = {r["n_words"]: r["count"] for r in known.groupBy("n_words").count().collect()}  # as many rows as short lengths
    if not lengths:
        return met
    bits, n = 64, sum(lengths.values())
    while bits < min(max_bits, 32 * n):
        bits *= 2
    firsts, wanted = "_t.first", "_t.seed"
    places = f"if(size(_h) = 0, cast(array() as array<int>), filter(sequence(0, size(_h) - 1), i -> {_in_table(firsts, '_h[i]', bits)}))"
    hit = ", ".join(f"filter(transform(filter(_at, i -> i + {k} <= size(_h)), i -> named_struct('at', i, 'seed', {_whole(k, '_h', 'i')})), x -> {_in_table(wanted, 'x.seed', bits)})" for k in sorted(lengths))
    found = f"transform(array({places}), _at -> concat({hit}))[0]"
    hits = _found(docs, own, text, found, _bit_table(known, "first", bits), _bit_table(known, "seed", bits))
    near = F.broadcast if n <= broadcast_rows else lambda df: df
    return met.unionByName(hits.join(near(known), "seed").select("_id", "_text_hash", "_item", "n_words", F.col("at").alias("_diagonal")))


def overlaps(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", min_words: int = 8, min_share: float = 0.6, max_bits: int = 1 << 22, broadcast_rows: int = 200_000) -> DataFrame:
    """One row for each document and each benchmark item that it overlaps: id, text_hash, item_id, and the
    matched_words of the stretch with the most of them and the span_words they stretch over (ties: the
    shortest)."""
    items = staged(benchmark_words(benchmark, item_id, item_text), "items")
    known = staged(seeds(items), "seeds")
    n = known.count()
    bits = 64
    while bits < min(max_bits, 32 * n):
        bits *= 2
    pairs, wanted = "_t.first", "_t.seed"
    # The arrays are bound as lambda variables: as columns they would be put in at each use and made anew
    # for every place.
    last = PAIR[1] + 1
    places = f"if(size(_h) < {last}, cast(array() as array<int>), filter(sequence(0, size(_h) - {last}), i -> {_in_table(pairs, _pair('i'), bits)}))"
    hit = ", ".join(f"filter(transform(filter(_at, i -> i + {max(m)} < size(_h)), i -> named_struct('at', i, 'seed', {_seed(k)})), x -> {_in_table(wanted, 'x.seed', bits)})" for k, m in enumerate(MASKS))
    found = f"transform(array({places}), _at -> concat({hit}))[0]"
    own = (F.col(f"`{id}`").alias("_id"), F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).alias("_text_hash"))
    near = F.broadcast if n <= broadcast_rows else lambda df: df
    hits = _found(docs, own, text, found, _bit_table(known, "pair", bits), _bit_table(known, "seed", bits))
    met = hits.join(near(known), "seed").select("_id", "_text_hash", "_item", "n_words", (F.col("at") - F.col("place")).alias("_diagonal"))
    met = staged(_with_short(met, docs, own, text, staged(short_seeds(items), "short"), max_bits, broadcast_rows).distinct(), "diagonals")
    n_met = met.count()
    # The words of the documents that have one; a bit table of their texts spares the others the shuffle.
    bits = 64
    while bits < min(max_bits, 32 * n_met):
        bits *= 2
    texts = _bit_table(met, "_text_hash", bits)
    few = _forget(docs.select(*own, F.col(f"`{text}`").cast("string").alias("_text")).filter(F.expr(_in_table(texts, "_text_hash", bits))), texts)
    few = few.groupBy("_id", "_text_hash").agg(F.first("_text").alias("_text")).select(F.col("_id").alias("_key"), F.col("_text_hash").alias("_key_hash"), F.expr(hashes_sql("_text")).alias("_h"))
    # The item's words on the diagonal, from its place _from on, against the document's.
    met = met.withColumn("_from", F.greatest(F.lit(0), -F.col("_diagonal"))).join(few, F.col("_text_hash").eqNullSafe(F.col("_key_hash")) & F.col("_id").eqNullSafe(F.col("_key")))
    met = met.select("_id", "_text_hash", "_item", "n_words", "_from", F.expr("slice(_h, _diagonal + _from + 1, n_words - _from)").alias("_there"))
    met = met.join(near(items), "_item").withColumn("places", F.expr("filter(transform(zip_with(_there, slice(_words, _from + 1, size(_there)), (x, y) -> x = y), (e, k) -> if(e, _from + k, -1)), p -> p >= 0)"))
    met = met.select("_id", "_text_hash", "item", "n_words", "places")
    enough = F.least(F.lit(min_words), F.col("n_words"))
    met = met.filter(F.size("places") >= enough).withColumn("matched", F.expr(_most("places", min_share))).filter(F.col("matched") >= enough)
    met = met.withColumn("span", F.expr("array_min(transform(sequence(matched, size(places)), k -> places[k - 1] - places[k - matched] + 1))"))
    best = met.groupBy("_id", "_text_hash", "item").agg(F.min(F.struct((-F.col("matched")).alias("m"), "span")).alias("b"))
    return best.select(F.col("_id").alias(id), F.col("_text_hash").alias("text_hash"), F.col("item").alias(item_id), (-F.col("b.m")).alias("matched_words"), F.col("b.span").alias("span_words"))


def clean(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs without the rows that overlap the benchmark; all columns stay."""
    found = staged(overlaps(docs, benchmark, id, text, **options).select(F.col(id).alias("_id"), "text_hash").distinct(), "overlaps")
    own = F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    return docs.join(found, own.eqNullSafe(F.col("text_hash")) & F.col(f"`{id}`").eqNullSafe(F.col("_id")), "left_anti")
