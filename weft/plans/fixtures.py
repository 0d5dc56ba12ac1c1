"""Inline rows for cases that the driver's tables do not hold, as Spark frames and as SQL VALUES."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LINES = [
    "| --- | :-- |", "| a | b |", "a | b", "- [x](http://a.b) tail", "[x](https://a.b)", "[x](https://a.b) tail", "http://a.b", "see http://a.b",
    "![i](p.png)", "![i](p.png) x", "[Skip to content", "x [Skip to", "Share this", "Shared", "Like it", "Liked", "Sign in", "Sign In now", "sign in",
    "Home", "home |", "Homes", "Menu -", "FAQ \\", "WordPress theme", "wordpresses", "tumblr", "- About WordPress", "- about", "- Search", "- Searching",
    "- Support", "- Supported", "Breaking News:", "Breaking News today", "close this dialog", "close this dialog now", "Close suggestions x", "SearchSearch", "SearchSearch 1",
    "Download free for 30 days", "Download free for days", "12 ratings yes", "ratings 12", "95% found this document useful (3)", "95% found", "10K views 3 pages", "10K views pages x",
    "Change Language", "en Change Language", "change language now", "en", "EN", "Facebook", "facebook page", "We use Cookies here", "cook", "it opens in a new window ok", "opens in a window",
    "ArticlePDF Available", "ArticlePDF", "doi : 10.1", "the doi: x", "Uploadedby me", "Uploadedbyme", "AI-english", "x AI-en", "PPTX, PDF", "PPT PDF", "7 views", "7 views today",
    "Latest", "Latest news", "MoreShare x", "MoreShared", "report abuse", "report abuse now", "", "plain prose line",
]
INLINE = [
    "a <b>bold</b> c", "x ![i](p) y", "[label](http://u.v/w) z", "[**bold**](u", "[**bold](u) t", "see [label]", "a [in] b", "[a][b](c [d]", "visit https://a.b/c?d now",
    "note [3] and [ 4 ]", "note ( 4 ) (5)", "a\\\\b", "a  |  b", "a \t  b", "[in](x)", "plain", "", "&lt;b&gt;x&lt;/b&gt; &amp; y",
]
DOCS = ["a\r\nb\rc", "a\x01b\x7fc\x0bd", "a\n\n\n\nb", "  \n x \n ", "\n\n", "", None, "one\n\ntwo\n\n\nthree", "tab\tkept\x1fgone"]
QUALITY = [" ".join(["word"] * n) for n in (29, 30, 49, 50)] + ["абвгде abcd " * 20, "абвгде abc " * 20, "аб abc " * 40, None, "", "   "]
CORPUS = [
    ("fil", "a~b~c n~g"), ("fil", "it' t\nwas"), ("fil", "Title : x\nbody text"), ("fil", "= x =\n== x\n...at\n* * *\nkept"), ("ceb", "one\n\n(salin)\n\ntwo"), ("fil", "one\n\n(salin)\n\ntwo"),
    ("fil", "a [ 2 ] b ( 3 ) c"), ("fil", "x   y\t\tz \n  q  "), ("fil", "1234\n\n\n\nword"), ("ilo", "&lt;p&gt; &amp; q"), ("fil", None), ("fil", ""),
]
SPLIT = [
    "", "one paragraph only", "a\n\nb\n\nc\n\nd\n\ne", "\n\n".join(["w " * 50] * 9), "\n".join(["w " * 66] * 7), "\n\n".join(["w " * 90] * 6), "\n\n".join(["w " * 40] * 5 + ["x"]), "\n".join(["w " * 100] * 2 + ["v"] * 6),
]
SYNCS = [
    ("f", 0, 0, 0.0, " {noise} "), ("f", 0, 1, 1.0, "isa dalawa tatlo (ubo)"), ("f", 0, 3, 4.0, ".."), ("f", 0, 4, 6.0, "apat  lima\nanim"), ("f", 1, 0, 6.5, "pito walo siyam"), ("f", 1, 1, 7.75, "una ikalawa"),
    ("f", 1, 2, 20.0, "{x} y {z}"), ("f", 1, 3, 25.0, "(lahat)"), ("g", 0, 0, 0.0, "isa dalawa tatlo apat"), ("g", 0, 1, 1.5, "isa dalawa tatlo"), ("g", 0, 2, 31.5, "isa dalawa tatlo lima"), ("g", 0, 3, 62.0, ""), ("g", 0, 4, 62.0, "a b c d"), ("g", 0, 5, 62.0, "huli ng lahat"),
]
STEMS = ["12_xx13xxxx_7", "3_xx00xxxx_1_tail", "4_xx24xxxx_9", "5_xx15xxxx_2", "6_xx19xxxx_2", "x12_xx13xxxx_7", "plain", ""]
WAVS = [("s1", 0, "v1/s1.wav"), ("s1", 3, "v4/s1.wav"), ("s2", 1, "v2/a/s2.wav"), ("s2", 1, "v2/b/s2.wav")]
TRANSCRIPTS = [("s1", "read"), ("s2", "machine"), ("s3", "read"), ("s4", "spontaneous")]


def frame(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)


def numbered(spark: SparkSession, rows: list, rest: str = "text string") -> DataFrame:
    return frame(spark, [(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], f"id int, {rest}")


def literal(x: object) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, str):
        if x.isprintable():
            return "'" + x.replace("'", "''") + "'"
        odd = sorted({c for c in x if not c.isprintable()})
        stand_in = {c: chr(0xE000 + i) for i, c in enumerate(odd)}
        quoted = "".join(stand_in.get(c, c) for c in x).replace("'", "''")
        return f"translate('{quoted}', '{''.join(stand_in.values())}', {' || '.join(f'chr({ord(c)})' for c in odd)})"
    return f"CAST({x} AS DOUBLE)" if isinstance(x, float) else str(x)


def values(rows: list, columns: str, number: bool = True) -> str:
    """(VALUES ...) AS fx(columns), with an id first if numbered."""
    full = [((i,) if number else ()) + (r if isinstance(r, tuple) else (r,)) for i, r in enumerate(rows)]
    body = ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in full)
    return f"(VALUES {body}) AS fx({'id, ' if number else ''}{columns})"
