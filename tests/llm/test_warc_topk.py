import base64
import gzip
import hashlib
import io
import zlib

import duckdb
import numpy as np
from pyspark.sql import functions as F

from weft.llm import queries, topk, warc

SF = "/root/testdata/sf0.001"


def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def expect_warc(rows, least=0):
    kept, out = {}, []
    body = lambda h: (h or "").encode()
    for i, _, h in rows:
        if i is not None and len(body(h)) >= least:
            kept[body(h)] = max(kept.get(body(h), i), i)
    n = {}
    for _, _, h in rows:
        n[body(h)] = n.get(body(h), 0) + 1
    for i, _, h in rows:
        to = kept.get(body(h)) if n[body(h)] > 1 and len(body(h)) >= least else None
        to = None if to == i else to
        out.append((i, len(body(h)), digest(body(h)), "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


def test_warc_round_trip(spark, tmp_path):
    big = "<p>é</p>" * 40_000
    rows = [(1, "http://a/1", "x"), (2, None, "x"), (3, "u\r\nv", None), (4, "u", ""), (5, "u", big), (6, "u", big + "!"), (7, "u", "y" * 9), (7, "u", "y" * 9), (None, "u", "x"), (None, None, "only"), (8, "\x1f\x8b\x08", "WARC/1.1\r\n\r\n\x1f\x08")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).repartition(3)
    for least in (0, 5):
        for split_bytes in (100, 1 << 22):
            manifest = warc.write(pages, f"file://{tmp_path}/w{least}_{split_bytes}", min_bytes=least)
            got = warc.read(manifest, split_bytes).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
            assert sorted(map(tuple, got), key=repr) == expect_warc(rows, least)
    full = warc.read(manifest, 1000, with_payload=True).filter("record_type = 'response' and page_id = 5").first()
    assert bytes(full["payload"]) == big.encode()
    empty = warc.write(pages.filter("false"), f"file://{tmp_path}/none")
    assert warc.read(empty).count() == 0


def test_warc_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, queries.op8_warc(spark, SF).collect()), key=repr) == expect_warc(rows)


def test_ranges_own_every_record_once():
    data = b"".join(warc.member(i, "u", (b"%d" % i) * (i * 50), None, "d", level) for i, level in enumerate([0, 6, 9, 0, 1]))

    class Source(io.BytesIO):
        def size(self):
            return len(data)

    for step in (7, 64, 333, 5000, len(data)):
        got = [warc.parse(r)["page_id"] for a in range(0, len(data), step) for _, r in warc.records(Source(data), a, a + step)]
        assert got == [0, 1, 2, 3, 4]


FOREIGN = [
    b"WARC/1.0\r\nwarc-type:warcinfo\r\nContent-Length:5\r\nContent-Type: application/warc-fields\r\n\r\na: b\n\r\n\r\n",
    b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://x/\r\n\tfolded\r\nCONTENT-TYPE: application/http\r\nContent-Length: 21\r\n\r\nHTTP/1.1 200\r\n\r\nhello\r\n\r\n",
    b"WARC/1.0\r\nWARC-Type: revisit\r\nWARC-Payload-Digest: md5:abc\r\nContent-Length: 0\r\n\r\n\r\n\r\n",
]


def test_foreign_and_damaged_archives(spark, tmp_path):
    whole = [gzip.compress(r) for r in FOREIGN]
    last = warc.member(9, "u", b"z" * 5000, None, "d", 0)
    (tmp_path / "a.warc.gz").write_bytes(b"".join(whole))
    (tmp_path / "cut.warc.gz").write_bytes(whole[1] + last[:-900])
    (tmp_path / "corrupt.warc.gz").write_bytes(last[:3000] + b"!" + last[3001:] + whole[1])
    (tmp_path / "junk.warc.gz").write_bytes(whole[1] + b"no member at all" + whole[2])
    for split_bytes in (50, 1 << 22):
        rows = warc.read(warc.manifest(spark, str(tmp_path / "*.gz")), split_bytes, with_payload=True).collect()
        good = sorted((r["record_type"], bytes(r["payload"]), r["url"], r["payload_digest"]) for r in rows if r["record_type"] != "damaged")
        response = ("response", b"hello", "http://x/ folded", digest(b"hello"))
        assert good == sorted([("warcinfo", b"a: b\n", None, digest(b"a: b\n")), *[response] * 4, ("revisit", b"", None, "md5:abc"), ("revisit", b"", None, "md5:abc")], key=lambda x: tuple(map(str, x)))
        bad = {r["url"].rsplit("/", 1)[1] for r in rows if r["record_type"] == "damaged"}
        assert bad == {f"cut.warc.gz@{len(whole[1])}", "corrupt.warc.gz@0", f"junk.warc.gz@{len(whole[1])}"}


def test_revisits_name_their_response(spark):
    record = lambda m: warc.header(zlib.decompress(m, 31))[0]
    first, again = record(warc.member(3, "u", b"x", None, "d")), record(warc.member(1, "v", b"x", 3, "d"))
    assert again["warc-refers-to"] == first["warc-record-id"] != again["warc-record-id"]


def brute(vectors, k):
    out = []
    rows = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in vectors if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    for i, q in {i: min(v for j, v in rows if j == i) for i, _ in rows if i % 50 == 0}.items():
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in rows if j != i and len(v) == len(q))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def test_top_k(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=6), 1)]) for i in range(420)]
    rows += [(500, None), (501, []), (502, [1.0, None]), (503, [float("nan")] * 6), (504, [float("inf")] * 6), (None, [0.0] * 6), (550, [1.0, 2.0]), (551, [2.0, 2.0]), (7, rows[7][1]), (600, [9e12] * 6), (601, [-9e12] * 6)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash")).repartition(3)
    for shard, block, leaf in ((16_384, 4096, 128), (60, 3, 4), (1000, 100, 1)):
        got = topk.top_k(d, F.col("vec_id") % 50 == 0, 5, shard_rows=shard, block_queries=block, leaf=leaf).collect()
        assert sorted(map(tuple, got)) == brute(rows, 5)
    assert topk.top_k(d.filter("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_huge_components(spark):
    """Scores beyond 64 bits are ranked exactly and reported as the nearest number that fits."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=3) * 10.0 ** rng.integers(0, 40)]) for i in range(220)]
    rows += [(1000, [1e10] * 3), (1001, [1e18] * 3), (1050, [3e38] * 3), (1051, [1.7e308] * 3)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    most = (1 << 63) - 1
    expect = [(q, r, i, max(-most, min(most, s))) for q, r, i, s in brute(rows[:-1], 5)]
    for shard in (16_384, 50):
        got = topk.top_k(d, F.col("vec_id") % 50 == 0, 5, shard_rows=shard, leaf=8).collect()
        assert sorted(map(tuple, got)) == expect


def test_top_k_equal_vectors(spark):
    d = spark.range(300).select(F.col("id").alias("vec_id"), F.array(F.lit(0.5), F.lit(0.25)).alias("embedding"))
    got = sorted(map(tuple, topk.top_k(d, F.col("vec_id") == 0, 3, leaf=10).collect()))
    assert [r[:3] for r in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 3)]


def test_top_k_query(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    expect = sorted(con.execute(queries.ORACLE_SQL["op9_top_k"]).fetchall())
    assert sorted(map(tuple, queries.op9_top_k(spark, SF).collect())) == expect
