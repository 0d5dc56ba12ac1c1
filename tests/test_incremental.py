"""Prefix-sum indices, splits by selection, the hash index with its recovery, shards written by tasks, cards."""

import hashlib
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from weft.functions.text import content_hash
from weft.operators import append, corpus, dedup, split, stats
from weft.operators.append import IndexedTable
from weft.sources import hash_index, readers, writers
from weft.sources.hash_index import HashIndex


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_running_index_sums_over_ranges_only(spark):
    """One source has nearly all files, each with one document; another has a file with many."""
    rows = [("big", f"{i:05d}", 0) for i in range(900)] + [("small", "f", i) for i in range(80)] + [(None, None, i) for i in range(5)]
    df = spark.createDataFrame(rows, "source string, file string, pos int").repartition(5)
    got = {tuple(r)[:3]: r["doc_idx"] for r in corpus.running_index(df, "source", "file", "pos").collect()}
    want, seen = {}, {}
    for r in sorted(rows, key=lambda r: (r[0] or "", r[1] or "", r[2])):
        want[r] = seen.get(r[0], 0)
        seen[r[0]] = want[r] + 1
    assert got == want
    placed = df.repartitionByRange(4, "source", "file", "pos").sortWithinPartitions("source", "file", "pos").withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_at", 33))
    shifts = corpus.range_shifts(placed, F.col("source"))
    assert shifts.count() <= 4 + 3  # ranges and sources
    text = plan(corpus.running_index(df, "source", "file", "pos"))
    window = text[text.index("== Physical Plan ==") :].split("Window")[1:]
    assert window and all("HashAggregate" in w for w in window)  # only totals are windowed


@pytest.mark.parametrize("few, digits", [(4096, 4), (3, 1)])
def test_split_by_selection(spark, monkeypatch, few, digits):
    """Against a sort; with small limits several rounds of counting find the cut."""
    monkeypatch.setattr(split, "FEW", few)
    monkeypatch.setattr(split, "DIGITS", digits)
    ids = [f"k{i}" for i in range(613)] + ["k5"] * 40
    df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(3)
    order = sorted(ids, key=lambda i: (hashlib.md5(f"7:{i}".encode()).hexdigest(), i))
    for tenths in (0, 1, 5, 9, 10):
        got = split.assign_split(df, F.col("id"), 7, tenths)
        train = sorted(r["id"] for r in got.filter("split = 'train'").collect())
        assert train == sorted(order[: len(ids) * tenths // 10]) and got.count() == len(ids)
    ranked = {r["id"]: r["rank"] for r in split.shuffled_rank(df.distinct(), F.col("id"), 7).collect()}
    assert [i for i, _ in sorted(ranked.items(), key=lambda x: x[1])] == list(dict.fromkeys(order))


def test_split_cuts_within_rows_that_share_an_id(spark):
    """A third of the rows has no id; wherever the cut falls, the parts are exact, and no row moves."""
    df = spark.range(0, 900, 1, 6).select(F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("id"), F.col("id").alias("n"))
    for tenths in range(1, 10):
        got = split.assign_split(df, F.col("id"), 42, tenths)
        assert got.filter("split = 'train'").count() == 900 * tenths // 10
    assert "Exchange" not in plan(got).split("== Physical Plan ==")[1]


def docs(spark, texts, split="train"):
    return spark.createDataFrame([(split, t) for t in texts], "split string, text string")


def texts_of(table) -> list:
    return sorted((r["text"] or "") for r in table.rows().select("text").collect())


def test_indexed_append_is_dedup_against(spark, tmp_path):
    """Three appends, against the plain way; in-batch copies stay, null counts as empty, generations merge."""
    batches = [["a", "b", None], ["b", "c", "c", ""], ["c", "d", None], ["d", "e"], ["f"]]
    table, plain = IndexedTable(spark, str(tmp_path / "t"), digits=1, merge_at=2), None
    for b in batches:
        counts = table.append(docs(spark, b)).first()
        new = dedup.dedup_against(docs(spark, b), plain)
        assert (counts["rows"], counts["added"], counts["removed"]) == (len(b), new.count(), len(b) - new.count())
        plain = new if plain is None else plain.unionByName(new)
        assert texts_of(table) == sorted((r["text"] or "") for r in plain.collect())
    assert table.index.whole() and len(table.index.generations()) <= 3
    assert table.append(docs(spark, ["a", "f", "e"])).first()["added"] == 0
    assert table.append(docs(spark, ["g", "g"]), within=True).first()["added"] == 1


def test_index_reads_the_buckets_of_a_batch_only(spark, tmp_path):
    hashes = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("hash"))
    index = HashIndex(spark, str(tmp_path / "i"), digits=1)
    index.add(hashes.limit(2000))
    index.digits = 2  # generations may differ in it
    index.add(hashes)
    some = hashes.limit(3).unionByName(spark.range(3000, 3003).select(F.md5(F.col("id").cast("string")).alias("hash")))
    finest = {r["hash"][:2] for r in some.collect()}
    scans = [line.split("PartitionFilters: [")[1] for line in plan(index.maybe(some)).split("== Physical Plan ==")[1].splitlines() if "PartitionFilters" in line]
    named = [set(re.findall(r"\b[0-9a-f]{1,2}\b", s.split("bucket#", 1)[1].split("(", 1)[1].split(")")[0])) if "IN (" in s else set(re.findall(r"= ([0-9a-f]{1,2})\b", s)) for s in scans]
    assert {frozenset(n) for n in named} == {frozenset(finest), frozenset(b[:1] for b in finest)}
    assert {r["hash"] for r in index.seen(some).collect()} == {r["hash"] for r in hashes.limit(3).collect()}
    # The filters let all known hashes through, and few others.
    others = spark.range(10_000, 20_000).select(F.md5(F.col("id").cast("string")).alias("hash"))
    assert index.maybe(hashes).select("hash").distinct().count() == 3000 and index.maybe(others).count() < 1500
    assert index.seen(others).count() == 0


@pytest.mark.parametrize("lost", ["all", "one"])
def test_lost_index_is_made_again(spark, tmp_path, lost):
    table = IndexedTable(spark, str(tmp_path / "t"), digits=1)
    for b in (["a"], ["b"], ["c"]):
        table.append(docs(spark, b))
    folder = tmp_path / "t.hashes"
    gone = sorted(folder.iterdir())[1] if lost == "one" else folder
    gone.rename(tmp_path / "aside")
    assert table.append(docs(spark, ["a", "b", "c", "d"])).first()["added"] == 1 and texts_of(table) == ["a", "b", "c", "d"]


@pytest.mark.parametrize("step", ["before rows", "some rows", "after rows", "after hashes"])
def test_append_that_stops_is_ended_by_the_next(spark, tmp_path, monkeypatch, step):
    table = IndexedTable(spark, str(tmp_path / "t"), digits=1)
    table.append(docs(spark, ["a"]))
    write, settle = IndexedTable._write, IndexedTable._settle

    def broken_write(self, new):
        if step == "some rows":
            new.drop("_hash").limit(2).write.mode("append").parquet(self.path)
        raise OSError("stopped")

    def broken_settle(self, new, indexed=False):
        if step == "after hashes":
            self.index.add(new.select(F.col("_hash").alias("hash")))
        raise OSError("stopped")

    with monkeypatch.context() as m:
        m.setattr(append.IndexedTable, *("_settle", broken_settle) if step.startswith("after") else ("_write", broken_write))
        with pytest.raises(OSError):
            table.append(docs(spark, ["a", "x", "x", "x", "y"]))
    assert write is IndexedTable._write and settle is IndexedTable._settle
    assert table.append(docs(spark, ["x", "z"])).first()["added"] == 1
    assert texts_of(table) == ["a", "x", "x", "x", "y", "z"] and not os.path.exists(table.pending)


def test_shards_of_a_failing_task_are_not_seen(spark, tmp_path):
    """Tasks end or leave nothing: every visible shard is whole and logged, and another run writes the rest only."""
    rows = split.shards(spark.range(1000).select(F.col("id").cast("string").alias("id")), F.col("id"), shard_rows=100).drop("rank")
    out, progress = str(tmp_path / "shards"), str(tmp_path / "progress")
    fail = F.when((F.col("split") == "test") & (F.col("shard") == 0), F.raise_error(F.lit("killed"))).otherwise(F.lit(1))
    with pytest.raises(Exception, match="killed"):
        writers.write_shards(rows.withColumn("x", fail), out, progress)
    seen = {p.name for p in (tmp_path / "shards").glob("*.parquet")} if (tmp_path / "shards").exists() else set()
    logged = {json.loads(line)["shard_name"] for p in (tmp_path / "progress").glob("*.json") for line in p.read_text().splitlines()} if (tmp_path / "progress").exists() else set()
    assert seen == logged and "test-00000-of-00001.parquet" not in seen and not (tmp_path / "shards/_writing").exists()
    now = {r["shard_name"]: r["rows"] for r in writers.write_shards(rows, out, progress).collect()}
    assert not set(now) & seen and len(now) + len(seen) == 10 and all(n == 100 for n in now.values())
    assert {r["id"] for r in spark.read.parquet(out).collect()} == {str(i) for i in range(1000)}


def test_observed_counts(spark, tmp_path):
    new = docs(spark, ["a", "b", "b"]).unionByName(docs(spark, ["a", "c"], "dev")).unionByName(docs(spark, [None], None))
    old = docs(spark, ["a", ""])
    seen = dedup.dedup_observed(new, old, ["train", "dev", None, "absent"])
    seen.rows.write.parquet(str(tmp_path / "t"))
    assert sorted(map(tuple, seen.counts().collect()), key=repr) == sorted(map(tuple, dedup.removal_counts(new, old).collect()), key=repr)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_card_states_add_up(spark, tmp_path):
    parts = [corpus.add_columns(docs(spark, t), s, lang) for t, s, lang in ((["a b", "c"], "x", "fil"), (["d e f"], "y", "fil"), ([None, "g"], "x", "ceb"))]
    for k, p in enumerate([parts[0], *parts]):  # the first twice, as after a failure
        state = stats.add_to_card(p, str(tmp_path / "states"), f"a{max(k - 1, 0)}")
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert sorted(map(tuple, state.collect()), key=repr) == sorted(map(tuple, stats.card_state(whole).collect()), key=repr)
    assert stats.render_state(state, "n", "fil") == stats.render_card(whole, "n", "fil") and "| Mean tokens | 1.4 |" in stats.render_card(whole, "n", "fil")
    assert "part-" in plan(state) or "parquet" in plan(state)
    empty = stats.render_card(whole.limit(0), "n", "fil")
    assert "| Documents | 0 |" in empty and "| **Total** | **0** | **0** |" in empty


def test_catalog_table_is_replaced_while_it_is_read(spark, tmp_path):
    root = str(tmp_path / "t")
    writers.publish_table(spark.range(4).withColumn("x", F.lit("a")), "weft_t", root)
    before = readers.dataset(spark, "weft_t")
    writers.publish_table(before.filter("id > 1"), "weft_t", root)
    assert before.count() == 4 and readers.dataset(spark, "weft_t", table=True).count() == 2  # old readers read on
    writers.append_table(spark.createDataFrame([(True, 9)], "new boolean, id long"), "weft_t")
    assert sorted(map(tuple, spark.table("weft_t").select("id", "x", "new").collect())) == [(2, "a", None), (3, "a", None), (9, None, True)]
    writers.publish_table(spark.range(1).withColumn("y", F.lit(1.5)), "weft_t", root)
    assert [tuple(r) for r in spark.table("weft_t").collect()] == [(0, 1.5)] and len([p for p in os.listdir(root) if p.startswith("v-")]) == 2
    spark.sql("DROP TABLE weft_t")


def test_bloom_slots_follow_the_hashes(spark, tmp_path):
    index = HashIndex(spark, str(tmp_path / "i"), digits=1)
    index.add(spark.range(1000).select(content_hash(F.col("id").cast("string")).alias("hash")))
    (g,) = index.generations()
    assert g.digits == 1 and g.words * hash_index.PER_SLOT * 16 >= 1000 and index.whole()
    index.rebuild(None)
    assert not index.whole() and index.seen(spark.createDataFrame([("a",)], "hash string")).count() == 0
