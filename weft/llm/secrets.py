"""Secret scans with character Markov models, in DataFrame and SQL functions only.

Base spans come from three fixed patterns. Further spans come from long tokens that a first-order
character model of random strings explains better than one of ordinary words and identifiers: the
log-likelihood ratio is summed over a token's character pairs and compared with a margin per pair.
Both models are counted from labelled samples (``labelled_samples``): strings that are random by
construction, and words of a bounded number of documents.

Defined results: a null text counts as empty and gives no spans; rows repeat as they come (nothing
is grouped by id); null ids pass through; an empty table gives an empty result; extra columns are
kept, and a clashing name is replaced by this operator's column. Every document is scanned whole.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import spread

#: The base patterns. Letters of the first match in either case.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")

#: A token that the models judge: 16 characters at least.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}"
CLASSES = 64
SPAN = "struct<start:int,kind:int,end:int>"


def _sql(text: str) -> str:
    """A SQL string literal of a pattern."""
    return "r'" + text + "'" if "'" not in text else '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"'


def _char_class(char: str) -> str:
    """SQL of the class of a one-character string: 0-25 a-z, 26-51 A-Z, 52-61 digits, 62 others."""
    code = f"ascii({char})"
    return f"(case when {code} between 97 and 122 then {code} - 97 when {code} between 65 and 90 then {code} - 39 when {code} between 48 and 57 then {code} + 4 else 62 end)"


def _pair(token: str, i: str) -> str:
    return f"{_char_class(f'substring({token}, {i}, 1)')} * {CLASSES} + {_char_class(f'substring({token}, {i} + 1, 1)')}"


def labelled_samples(docs: DataFrame, sample_docs: int = 1000, strings: int = 3000, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Rows (token, random). Random: hex, base-64, upper-case and letters-only forms of SHA-256 digests.
    Ordinary: tokens of about `sample_docs` documents (chosen by a hash of id and text; the tokens stay where
    they are and only counts of character pairs are ever gathered), base spans removed, and identifiers and
    paths made of three words in a row of theirs."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    b64 = F.regexp_replace(F.base64(F.unhex(F.concat(digest, F.sha2(digest, 256)))), "[^A-Za-z0-9]+", "")
    upper, letters = F.substring(F.upper(b64), 1, 24), F.substring(F.regexp_replace(b64, "[^A-Za-z]", ""), 1, 32)
    forms = F.array(F.substring(digest, 1, 40), F.substring(F.base64(F.unhex(digest)), 1, 43), upper, letters, F.lower(F.substring(letters, 1, 24)))
    made = docs.sparkSession.range(strings).select(F.explode(forms).alias("token"), F.lit(True).alias("random"))
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    n = docs.count()
    few = docs if n <= sample_docs else docs.filter(F.pmod(F.xxhash64(F.col(f"`{id}`").cast("string"), body), F.lit(1 << 31)) < int((1 << 31) * sample_docs / n))
    few = spread(few.select(body.alias("t")))
    for pattern in (ASSIGN, ACCESS, HEX):
        few = few.select(F.regexp_replace("t", pattern, " ").alias("t"))
    three = "concat_ws('{}', slice(w, i, 3))"
    forms = ", ".join([three.format("_"), f"upper({three.format('_')})", f"replace(initcap({three.format(' ')}), ' ', '')", three.format("/"), three.format("-")])
    joined = f"flatten(transform(if(size(w) < 3, array(), sequence(1, size(w) - 2, 3)), i -> array({forms})))"
    found = F.expr(f"""concat(regexp_extract_all(t, '[A-Za-z0-9+/_-]{{3,}}', 0),
        transform(array(regexp_extract_all(t, '[A-Za-z]{{3,}}', 0)), w -> {joined})[0])""")
    return made.unionByName(few.select(F.explode(found).alias("token"), F.lit(False).alias("random")))


def train(samples: DataFrame, smoothing: float = 0.5) -> list[float]:
    """Log-likelihood ratios (random against ordinary) of the next class given the last, CLASSES²
    values. At most 2·CLASSES² counts reach the driver, whatever the samples' size."""
    pairs = samples.select("random", F.explode(F.expr(f"transform(sequence(1, greatest(length(token) - 1, 1)), i -> {_pair('token', 'i')})")).alias("pair"))
    counts = {(r["random"], r["pair"]): r["n"] for r in pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).collect()}
    ratios = []
    for last in range(CLASSES):
        row = {kind: [counts.get((kind, last * CLASSES + nxt), 0) + smoothing for nxt in range(CLASSES)] for kind in (True, False)}
        total = {kind: sum(values) for kind, values in row.items()}
        ratios += [round(math.log(row[True][nxt] / total[True]) - math.log(row[False][nxt] / total[False]), 4) for nxt in range(CLASSES)]
    return ratios


def scan(docs: DataFrame, ratios: list[float], text: str = "text", margin: float = 0.3, letters_margin: float = 1.2, distinct: int = 8) -> DataFrame:
    """docs with `secret_spans`: array of struct(start, kind, end), code points, end exclusive, ordered
    by start then kind (an index into KINDS). A Markov span is added where the mean ratio per pair is at
    least `margin` and no base span overlaps it. A token without a digit or without a letter may be a long word, a
    path, a rule or a number: it needs `letters_margin` and `distinct` characters."""
    t = f"coalesce(cast(`{text}` as string), '')"
    df = docs.withColumn("_t", F.expr(t))

    def located(matches: str, kind: int, keep: str = "true") -> str:
        # A literal's first place at or after the last match's end is the match's own place: an earlier
        # place would itself have matched there.
        return f"""aggregate({matches}, named_struct('pos', 1, 'out', cast(array() as array<{SPAN}>)),
            (a, m) -> named_struct('pos', locate(m.s, _t, a.pos) + length(m.s), 'out', if({keep}, concat(a.out, array(named_struct(
              'start', locate(m.s, _t, a.pos) - 1, 'kind', {kind}, 'end', locate(m.s, _t, a.pos) - 1 + length(m.s)))), a.out)), a -> a.out)"""

    whole = lambda pattern: f"transform(regexp_extract_all(_t, {_sql(pattern)}, 0), x -> named_struct('s', x))"
    assign = f"zip_with(regexp_extract_all(_t, {_sql(ASSIGN)}, 0), regexp_extract_all(_t, {_sql(ASSIGN)}, 2), (s, v) -> named_struct('s', s, 'v', v))"
    df = df.withColumn("_base", F.expr(f"""array_sort(concat(
        if(_t rlike {_sql(ASSIGN)}, {located(assign, 0, 'length(m.v) >= 6')}, cast(array() as array<{SPAN}>)),
        if(_t rlike {_sql(ACCESS)}, {located(whole(ACCESS), 1)}, cast(array() as array<{SPAN}>)),
        if(_t rlike {_sql(HEX)}, {located(whole(HEX), 2)}, cast(array() as array<{SPAN}>))))"""))
    table = f"from_json('{ratios}', 'array<double>')"
    score = f"aggregate(sequence(1, length(m.s) - 1), 0D, (z, i) -> z + element_at(_llr, {_pair('m.s', 'i')} + 1))"
    needs = f"if(m.s rlike '[0-9]' and m.s rlike '[A-Za-z]', {margin}D, if(size(array_distinct(split(m.s, ''))) >= {distinct}, {letters_margin}D, double('inf')))"
    judged = f"{score} >= {needs} * (length(m.s) - 1)"
    df = df.withColumn("_llr", F.expr(table)).withColumn("_markov", F.expr(f"if(_t rlike {_sql(TOKEN)}, {located(whole(TOKEN), 3, f'{judged}')}, cast(array() as array<{SPAN}>))"))
    free = "filter(_markov, x -> not exists(_base, b -> b.start < x.end and x.start < b.end))"
    return df.withColumn("secret_spans", F.expr(f"array_sort(concat(_base, {free}))")).drop("_t", "_base", "_llr", "_markov")


def redact(scanned: DataFrame, text: str = "text", mask: str = "[secret]") -> DataFrame:
    """scanned with every span of `secret_spans` replaced by `mask` (overlapping spans by one) and the
    spans dropped. A row without spans keeps its text as it is, null included."""
    cut = f"""aggregate(secret_spans, named_struct('pos', 0, 'out', ''),
        (a, s) -> if(s.end <= a.pos, a, named_struct('pos', s.end, 'out', concat(a.out, if(s.start >= a.pos, concat(substring(`{text}`, a.pos + 1, s.start - a.pos), '{mask}'), '')))),
        a -> concat(a.out, substring(`{text}`, a.pos + 1)))"""
    return scanned.withColumn(text, F.expr(f"if(size(secret_spans) = 0, `{text}`, {cut})")).drop("secret_spans")
