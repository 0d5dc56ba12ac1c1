"""Cases in which Python's ``re`` and RE2 differ, as pairs of input and expected result."""

from pyspark.sql import functions as F

from weft.functions import text as T

#: (line, whether it is boilerplate): words end at letters and marks of all scripts, case is Unicode's where it is ignored.
LINES = [
    ("Like½", False), ("Likeñ", False), ("Like it", True), ("WordPress\u0301", True), ("WordPress x", True), ("cooKie", True), ("COOKIE", True), ("cooKie", True), ("Share\xa0this", True),
    ("\xa0en\xa0", True), ("\u2003Latest\u2003", True), ("Sign ın", False), ("sıgn in", False), ("ſearch", True), ("٣ ratings", True), ("³ ratings", False), ("٣% found this document useful", True),
    ("Openſ in a new window", True), ("Opens\xa0in a new window", False), ("https://a.b\xa0", True), ("Home\u2028", True), ("Uploadedby\u0301", True), ("MoreShare_", False), ("- Search\u3000", True),
]
#: (text, cleaned text, words)
TEXTS = [
    ("a &#10; b &#13; c &#12; d &#x2028; e &copy2 f &notit; &amp;lt;", "a \n b \r c \x0c d \u2028 e ©2 f ¬it; &lt;", 13),
    ("one\xa0two\u2003three", "one\xa0two\u2003three", 3),
    ("x\x85y z", "x\ny z", 3),
    ("p\u2028q r", "p\nq r", 3),
    ("k\x1cl m", "kl m", 3),
    ("“Curly” ‘quotes’ — dash…", "“Curly” ‘quotes’ — dash…", 4),
    ("see [label]\xa0", "see label", 2),
    ("visit https://a.b\xa0now", "visit \xa0now", 3),
    ("( ٣ ) [ 12\u2003]", "", 6),
    ("a\xa0|\xa0b", "a b", 3),
    ("line one\r\nline\rtwo\n\n\n\nthree &amp; four\n&lt;b&gt;bold&lt;/b&gt;", "line one\nline\ntwo\n\nthree & four\nbold", 8),
    ("[a][b](c [d]", "ab c d", 2),
    ("&", "", 1),
    ("", "", 0),
    (None, "", 0),
]
#: (text, share of Latin characters): white space counts on neither side.
RATIOS = [("abc", 1.0), ("ab жц", 0.5), ("\u2003\u3000 a", 1.0), ("\u3000\x1c", 0.0), ("", 0.0), (None, 0.0), ("ɏɐ", 0.5), ("a😀", 0.5), ("ж", 0.0), ("é\x85\u2028ñ漢字", 0.5)]


def results(spark, cases, f):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, x string")
    return [r[1] for r in sorted(df.select("i", f(F.col("x"))).collect())]


def test_boilerplate_lines(spark):
    assert list(zip(LINES, results(spark, LINES, T.is_boilerplate))) == [(c, c[1]) for c in LINES]


def test_cleaned_texts(spark):
    assert results(spark, TEXTS, T.clean_text) == [c[1] for c in TEXTS]
    many = [("\n".join(f"row {i} &amp; more" for i in range(200)),)]
    assert results(spark, many, T.clean_text) == ["\n".join(f"row {i} & more" for i in range(200))]


def test_words(spark):
    assert results(spark, TEXTS, T.word_count) == [c[2] for c in TEXTS]


def test_latin_ratio(spark):
    assert results(spark, RATIOS, T.latin_ratio) == [c[1] for c in RATIOS]
