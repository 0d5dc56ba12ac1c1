"""Turn reassembly against its SQL, URL filters and spelling variants against brute force; odd rows of all three."""

import os
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from weft.llm import queries, spelling, turns, urls

SF = "/root/testdata/sf0.001"


def put(df, folder, name):
    df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


# 11. conversation turns


def odd_turns():
    """Nulls, equal payloads of other roles, copies, turns below zero, gaps, and a long conversation."""
    rng = np.random.default_rng(8)
    rows = [(None, k, "user", f"n{k}") for k in range(5)] + [(1, None, "user", "x"), (None, None, None, None)]
    rows += [(2, k, None if k % 2 else "user", None if k % 3 else "t") for k in range(9)]
    rows += [(3, 4, "a|b", "c"), (3, 4, "a", "b|c"), (3, 5, "é", "z"), (3, 5, "z", "é"), (3, -2, "user", "below"), (3, -1, "user", "zero")]
    rows += [(4, int(k), "user", "u") for k in rng.choice(400, 120, replace=False)] + [(5, 7, "user", "only")]
    rows += [(10 + c, t, ["user", "assistant"][t % 2], f"{c}:{t}") for c in range(40) for t in range(int(rng.integers(1, 12))) if rng.random() < 0.9]
    return rows + rows[:6]


def test_turns_query_matches_its_sql(spark, tmp_path):
    made = spark.createDataFrame([(*r, 99, "x", True) for r in odd_turns()], "conv_id long, turn long, role string, text string, batch int, event string, tick boolean")
    table = spark.read.parquet(f"{SF}/conversations.parquet").withColumn("conv_id", F.col("conv_id") + 1000)
    put(made.unionByName(table, allowMissingColumns=True), tmp_path, "conversations")
    got = queries.op11_turns(spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.execute(queries.ORACLE_SQL["op11_turns"]).df()
    plain = lambda df: sorted((tuple(None if v is None or v != v else v if isinstance(v, str) else int(v) for v in r) for r in df[want.columns].astype(object).where(df[want.columns].notna(), None).values.tolist()), key=repr)
    assert plain(got) == plain(want) and set(got["event"]) == {"release", "reject", "close"}


def test_turns_of_an_empty_table_and_real_outputs(spark):
    """The operator's own outputs, over few batches: texts, turns that wait, role breaks at seams; and no rows."""
    rows = [(0, 1, 0, "u", "a"), (0, 1, 2, "u", "c"), (1, 1, 1, "u", "b"), (0, 2, 5, "s", "x"), (0, 2, 7, "s", "y"), (1, 2, 8, "s", "z"), (5, 2, 6, "s", "late"), (4, 3, 1, "u", "q"), (5, 3, 1, "u", "other")]
    schema = "batch int, conv_id long, turn long, role string, text string"
    got = [tuple(r) for r in turns.replay(spark.createDataFrame(rows, schema), 6).select("event", "conv_id", "turn", "batch", "text", "waiting", "n_missing", "n_breaks").collect()]
    release = lambda c, t, b, text: ("release", c, t, b, text, None, None, None)
    assert sorted(got) == sorted([
        release(1, 0, 0, "a"), release(1, 1, 1, "b"), release(1, 2, 1, "c"), ("close", 1, -1, 3, None, "", 0, 2), release(2, 5, 0, "x"), ("close", 2, -1, 3, None, "7,8", 1, 1),
        ("reject", 2, 6, 5, "late", None, None, None), release(3, 1, 4, "q"), ("close", 3, -1, 6, None, "", 0, 0),
    ])
    assert turns.replay(spark.createDataFrame([], schema), 1).count() == 0


# 12. URL filters


def slot(grams: bytes) -> int:
    """The scalar form of the model's slots: bytes are mixed in from the first."""
    h = 0
    for b in grams:
        h = (h * urls.MIX[0] + b + 1) % 2**64
        h = (h ^ (h >> 29)) * urls.MIX[1] % 2**64
    return h >> (64 - urls.BITS)


def brute_urls(labelled, asked):
    """Scores of the asked URLs by dicts of counts."""
    text = lambda u: bytes([urls.START]) * urls.ORDERS + u.encode().translate(urls.LOWER) + bytes([urls.END])
    counts = {c: [{} for _ in range(urls.ORDERS)] for c in (0, 1)}
    for u, c in labelled:
        t = text(u)
        for i in range(urls.ORDERS - 1, len(t)):
            for k in range(urls.ORDERS):
                s = slot(t[i - k : i + 1])
                counts[c][k][s] = counts[c][k].get(s, 0) + 1
    out = {}
    for u in asked:
        t, logs = text(u or ""), []
        for c in (1, 0):
            total, held = 0.0, counts[c]
            for i in range(urls.ORDERS, len(t)):
                p = (held[0].get(slot(t[i : i + 1]), 0) + 1) / (sum(held[0].values()) + 256)
                for k in range(1, urls.ORDERS):
                    n, m = held[k].get(slot(t[i - k : i + 1]), 0), held[k - 1].get(slot(t[i - k : i]), 0)
                    p = (n + urls.WEIGHT * p) / (max(m, n) + urls.WEIGHT)
                total += np.log(p)
            logs.append(total)
        out[u] = (logs[0] - logs[1]) / (len(t) - urls.ORDERS) if u and all(sum(counts[c][0].values()) for c in (0, 1)) else 0.0
    return out


RULES = [("example.net/en/", "example.net", "/en/", "allow"), ("example.com/de/", "example.com", "/de/", "block"), ("org/fr/", "org", "/fr/", "allow"), ("net/", "net", "/", "block")]


def brute_rule(u):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
    host, path = (re.sub("[A-Z]+", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    return host, path, next(((r, v) for r, h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)), (None, None))


ODD_URLS = [None, "", "no scheme", "HTTP://A.EXAMPLE.Net/en/x?y#z", "http://example.net", "http://example.net?/en/", "x://y://z.org/fr/a", "http://notexample.com/de/", "http://éÀ.ORG/fr/é", "http://org/fr/", "http://a.net/" + "q" * 5000, "http:///p", "a\n://b.net/c"]


def test_url_query_against_brute_force(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    odd = spark.createDataFrame([(i if i % 4 else None, u) for i, u in enumerate([*ODD_URLS, *ODD_URLS[:4]], 10**6)], "page_id long, url string")
    put(pages.unionByName(odd).withColumns({"host": F.lit("clash"), "verdict": F.lit(1), "_rule": F.lit(2), "score": F.lit("s")}), tmp_path, "pages")
    rows = [r["url"] for r in spark.read.parquet(f"{tmp_path}/pages.parquet").collect()]
    held = {r["url"] for r in spark.createDataFrame([(u,) for u in rows], "url string").filter(F.pmod(F.xxhash64("url"), F.lit(urls.HELD)) == 0).collect()}
    labelled = [(u, int(brute_rule(u)[2][1] == "allow")) for u in rows if brute_rule(u)[2][0]]
    scores = brute_urls([(u, c) for u, c in labelled if u not in held], rows)
    bins = {}
    for u, c in labelled:
        if u in held:
            b = (int(np.floor(min(max(scores[u], -urls.MOST), urls.MOST) * urls.FINE)), bool(c))
            bins[b] = bins.get(b, 0) + 1
    threshold = urls.best_threshold(bins)
    got = queries.op12_urls(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and sorted(r["page_id"] or -1 for r in got) == sorted(r["page_id"] or -1 for r in spark.read.parquet(f"{tmp_path}/pages.parquet").collect())
    by = {(r["host"], r["path"], r["rule"], r["verdict"], round(r["score"], 4)) for r in got}
    want = {(h, p, rule, v or ("allow" if scores[u] >= threshold else "block"), round(scores[u], 4)) for u in rows for h, p, (rule, v) in [brute_rule(u)]}
    assert by == want and {r["rule"] for r in got} == {None, "net/", "example.net/en/", "example.com/de/", "org/fr/"}


def test_url_model_tells_sorts_of_urls_apart(spark):
    """Held-out URLs of two sorts, by what hosts and paths are made of; the threshold follows labels that are shifted."""
    rng = np.random.default_rng(6)
    pick = lambda *w: str(rng.choice(w))
    good = lambda: f"https://{pick('www', 'blog', 'docs')}.{pick('library', 'history', 'garden', 'music')}{pick('club', 'house', 'notes')}.org/{pick('articles', 'essays', 'reviews')}/{rng.integers(999)}"
    bad = lambda: f"http://{pick('win', 'free', 'best')}-{pick('casino', 'bets', 'pills', 'loans')}{rng.integers(99)}.biz/{pick('go', 'click', 'promo')}.php?ref={rng.integers(10**6)}"
    rows = spark.createDataFrame([(f(), f is good) for f in (good, bad) for _ in range(400)], "url string, accepted boolean")
    model = urls.train(rows)
    asked = spark.createDataFrame([(int(f is good), f()) for f in (good, bad) for _ in range(200)], "page_id long, url string")
    got = urls.judge(asked, model, [], ["page_id"]).collect()
    assert sum((r["verdict"] == "allow") == bool(r["page_id"]) for r in got) >= 398 and all(r["rule"] is None for r in got)


def test_url_pieces_and_thresholds(spark, monkeypatch):
    model = urls.train(spark.createDataFrame([(f"http://{'good' if i % 2 else 'evil'}{i}.com/x", i % 2 == 1) for i in range(200)], "url string, accepted boolean"))
    asked = ["http://good.com/" + "a" * 700, None, "http://evil.com", ""]
    whole = model.scores(asked)
    monkeypatch.setattr(urls, "PIECE", 50)
    assert np.allclose(model.scores(asked), whole) and whole[0] > whole[2] and whole[1] == whole[3] == 0
    assert urls.best_threshold({}) == 0 and urls.best_threshold({(5, True): 3}) == 0
    assert urls.best_threshold({(-64, False): 9, (63, True): 9}) == 0 and urls.best_threshold({(0, False): 9, (9, True): 9, (20, False): 1}) == 5 / urls.FINE
    empty = spark.createDataFrame([], "page_id long, url string")
    nothing = urls.train(urls.ruled_urls(empty, queries.RULES))
    assert urls.judge(empty, nothing, queries.RULES, ["page_id"]).count() == 0 and not nothing.known
    assert urls.judge(spark.createDataFrame([(1, "http://x.de/")], "page_id long, url string"), nothing, queries.RULES, ["page_id"]).first()["verdict"] == "allow"


# 13. spelling variants


def brute_words(rows, every=97):
    counts = {}
    for i, t in rows:
        for w in re.findall("[A-Za-z\u00c0-\u00ff]+", t or ""):
            w = re.sub("[A-Z]+", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] = counts.get(w, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a != b and (a[k:] == b[k + 1 :] if len(a) < len(b) else len(a) == len(b) and a[k + 1 :] == b[k + 1 :])


def brute_variants(counts):
    out = {}
    by = {}
    for w in counts:
        by.setdefault(len(w), []).append(w)
    for w, n in counts.items():
        near = [x for k in (-1, 0, 1) for x in by.get(len(w) + k, []) if one_edit(w, x)]
        form = min(near, key=lambda x: (-counts[x], x), default=None)
        if form is not None and counts[form] < 2 * n:
            form = None
        out[w] = [form, w, n, len(near), counts[form] if form else None]
    for w in out:
        while out[out[w][1]][0]:
            out[w][1] = out[out[w][1]][0]
    return {(w, *v) for w, v in out.items()}


def test_spelling_query_against_brute_force(spark, tmp_path, edge_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    chain = " ".join(["stones"] * 3 + ["stonec"] * 7 + ["stonecs"] * 15 + ["stonecsu"] * 40 + ["ÉCOLE"] * 9 + ["École", "école"] * 4 + ["a×÷ÿz"] * 3 + ["a×÷ÿzz"] * 7 + ["x" * 4000] * 5 + ["x" * 4001] * 11 + ["tiesa"] * 6 + ["tiesb"] * 6 + ["tiesc"] * 3)
    made = spark.createDataFrame([(10**6, chain), (None, chain), (None, None), (5, ""), (6, "1 2 3 \x00")], "doc_id long, text string")
    put(docs.unionByName(made).unionByName(edge_docs.select("doc_id", "text")).withColumns({"word": F.lit(1), "n": F.lit("k")}), tmp_path, "documents")
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect()]
    got = {tuple(r) for r in queries.op13_spelling(spark, str(tmp_path)).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == brute_variants(brute_words(rows)) and any(f and f != r for _, f, r, *_ in got)


@pytest.mark.parametrize("block, letters", [(8192, "abcé"), (7, "ab"), (3, "abcdefghij")])
def test_variants_of_cut_shards(spark, monkeypatch, block, letters):
    """Dense vocabularies, in which most words have near ones; small blocks and slices give the same rows."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    rng = np.random.default_rng(block)
    counts = {"".join(rng.choice(list(letters), rng.integers(5, 9))): int(rng.integers(3, 60)) for _ in range(500)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert {tuple(r) for r in spelling.variants(words).collect()} == brute_variants(counts)


def test_variants_of_nothing(spark, empty_docs):
    assert spelling.variants(spelling.vocabulary(empty_docs, typo_every=97)).count() == 0
    lone = spelling.variants(spark.createDataFrame([("alone", 3)], "word string, n long")).collect()
    assert [tuple(r) for r in lone] == [("alone", None, "alone", 3, 0, None)]
    assert os.path.exists(SF)
