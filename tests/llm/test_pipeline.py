"""The pipeline against a brute-force version of its stages, and its stages on odd rows."""

import re

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_text_operators import brute_components, brute_languages, brute_spans, check_pieces
from weft.llm import queries, secrets
from weft.llm.tokens import Encoder

SF = "/root/testdata/sf0.001"
TOKEN = re.compile(secrets.TOKEN)


def char_class(c):
    o = ord(c)
    return o - 97 if 97 <= o <= 122 else o - 39 if 65 <= o <= 90 else o + 4 if 48 <= o <= 57 else 62


def redacted(text, ratios):
    spans = brute_spans(text)
    for m in TOKEN.finditer(text):
        s = m[0]
        score = sum(ratios[char_class(a) * secrets.CLASSES + char_class(b)] for a, b in zip(s, s[1:]))
        needs = 0.3 if re.search("[0-9]", s) and re.search("[A-Za-z]", s) else 1.2 if len(set(s)) >= 8 else float("inf")
        if score >= needs * (len(s) - 1) and not any(a < m.end() and m.start() < e for a, _, e in brute_spans(text)):
            spans.append((m.start(), 3, m.end()))
    out, pos = "", 0
    for a, _, e in sorted(spans):
        if e > pos:
            out += text[pos:a] + "[secret]" if a >= pos else ""
            pos = e
    return out + text[pos:]


def test_pipeline_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    named = brute_languages([(r["doc_id"], r["text"], r["lang"]) for r in rows])
    fine = lambda i: named[i][0] != "und" and named[i][1] >= corpus_pipeline.MIN_SCORE and named[i][2] >= corpus_pipeline.MIN_KNOWN
    texts = {r["doc_id"]: r["text"] for r in rows if fine(r["doc_id"])}
    texts = {i: texts[i] for i, _, c in brute_components(list(texts.items()), 5, 80) if i == c}
    words = lambda t: [w for w in re.split(r"[\W_]+", t.lower()) if w]
    grams = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r["text"])
        grams |= {tuple(w[k : k + 8]) for k in range(len(w) - 7)}
    texts = {i: t for i, t in texts.items() if not any(tuple(words(t)[k : k + 8]) in grams for k in range(len(words(t)) - 7))}
    left = spark.createDataFrame([r for r in rows if r["doc_id"] in texts], spark.read.parquet(f"{SF}/documents.parquet").schema)
    ratios = secrets.train(secrets.labelled_samples(left))
    texts = {i: redacted(t, ratios) for i, t in texts.items()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert 0 < len(texts) < len(rows) and {r["doc_id"] for r in got} == set(texts)
    check_pieces(got, texts, Encoder(queries.word_tokenizer()).library, 1, 2048)


def test_stages_keep_the_columns_and_bear_odd_rows(spark, edge_docs, empty_docs):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (edge_docs, empty_docs):
        docs = docs.select(columns)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == columns and out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).columns[0] == "doc_id"
    clash = {"score": "user's", "known": 2, "lang_pred": "x", "secret_spans": [1], "_text": "t", "_id": 3, "component_id": 4, "_changed": True, "a.b": None}
    more = edge_docs.select(columns).withColumns({k: F.lit(v).cast("int") if v is None else F.array(F.lit(1)) if v == [1] else F.lit(v) for k, v in clash.items()})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, more, SF)
        rows = out.collect()
        assert out.columns == more.columns and rows and all({k: r[k] for k in clash} == clash for r in rows)
    assert corpus_pipeline.STAGES[-1][1](spark, more, SF).count() >= more.count()
    kept = corpus_pipeline.near_duplicates(spark, edge_docs.select(columns), SF)
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(6) == 0 or ids.count(6) == 1
    assert sorted(i for i in ids if i is not None) == sorted(set(i for i in ids if i is not None)) and ids.count(None) == 2


def test_language_stage_rejects_what_it_cannot_name(spark):
    """Other languages, random letters and texts without letters go; clean documents of all languages stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [
        (10**6, "Metsän reunalla seisoi vanha talo jonka ikkunoista näkyi järvelle asti kun sumu hälveni aamulla hitaasti pois"), (10**6 + 1, "Съешь же ещё этих мягких французских булок да выпей чаю"),
        (10**6 + 2, "xkqz vwpt jjhg qqzk wvbn mmxz pplk zzxc vvbq kkjw" * 3), (10**6 + 3, "12345 --- 6789"), (10**6 + 4, None), (10**6 + 5, ""),
    ]
    more = docs.unionByName(spark.createDataFrame([(i, t, None, "s", None) for i, t in odd], docs.schema))
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, more, SF).select("doc_id").collect()}
    long = {r["doc_id"] for r in docs.filter("n_chars >= 100").select("doc_id").collect()}
    assert not kept & {i for i, _ in odd} and long <= kept
