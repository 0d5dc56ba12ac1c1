"""License scans by a positional rare-token index.

Words are runs of ASCII letters (lower-cased), digits and non-ASCII characters. Every template is a
word sequence of a licence's text or notice, and the index holds the positions of all its words. A file
that has any of a template's rarest words by corpus IDF looks up its own highest-IDF words of that template;
each occurrence votes for the place where the template would start, and places that differ by at most `slack`
words vote together. Where enough of the words agree, the template is verified: a base phrase in all its
words, another template in most of its words, with words inserted or left out as far as `slack` goes, and in
its mandatory key phrase word by word.

Defined results: null and empty texts have 0 words and no labels (score 0, null first and last word);
repeated rows and ids each get their own row; null ids pass through; an empty table gives an empty
result; columns not kept are dropped and kept ones that clash with a result column give way.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.arrowmap import arrow_schema, broadcast, map_text
from weft.llm.license_texts import TEXTS
from weft.session import ship

#: The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: ASCII upper case to lower case, other ASCII than letters and digits to spaces; other bytes stay.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))

RESULT = "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double, matches array<struct<label:string,word:long,score:double>>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def document_frequencies(docs: DataFrame, vocabulary: set[bytes], text: str = "text") -> tuple[int, dict[bytes, int]]:
    """The number of documents, and of those that hold each word of a fixed vocabulary; over all rows.
    As many rows as the vocabulary has words reach the driver."""
    ship(docs.sparkSession)
    out = arrow_schema("word string, n long")

    def count(batches):
        df: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                df.update(vocabulary.intersection(words_of(text)))
                df[b""] += 1
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in df], pa.string()), pa.array(list(df.values()), pa.int64())], schema=out)

    rows = docs.select(F.col(f"`{text}`").cast("string")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r["word"].encode(): r["n"] for r in rows}
    return found.pop(b"", 0), found


class RareTokenIndex:
    """Positions of all templates' words, and the words by which a file comes to look at a template."""

    def __init__(self, n_docs: int, df: dict[bytes, int], rare: int = 8, coverage: float = 0.8, slack: int = 4):
        self.coverage, self.slack, self.rare = coverage, slack, rare
        self.idf = {w: math.log((n_docs + 1) / (df.get(w, 0) + 1)) for w in vocabulary()}
        self.templates = [(words_of(p), words_of(p), label, True) for p, label in BASE.items()] + [(words_of(t), words_of(key), label, False) for label, key, t in TEXTS]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.gate: dict[bytes, list[int]] = defaultdict(list)
        for k, (words, _, _, base) in enumerate(self.templates):
            for j, w in enumerate(words):
                self.postings[w].append((k, j))
            # A base phrase needs all its words, so its rarest alone finds all its places.
            for w in self._rarest(set(words))[: 1 if base else rare]:
                self.gate[w].append(k)
        self.words = frozenset(self.gate)

    def _rarest(self, words: set[bytes]) -> list[bytes]:
        return sorted(words, key=lambda w: (-self.idf[w], w))

    def find(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, place, share of its words that match), by place."""
        if self.words.isdisjoint(words):
            return []
        places: dict[bytes, list[int]] = defaultdict(list)
        for i, w in enumerate(words):
            if w in self.postings:
                places[w].append(i)
        found = []
        for k in sorted({k for w in self.words.intersection(places) for k in self.gate[w]}):
            template, key, _, base = self.templates[k]
            mine = self._rarest(set(template).intersection(places))[: 1 if base else self.rare]
            votes: Counter = Counter()
            for w in mine:
                votes.update({i - j for t, j in self.postings[w] if t == k for i in places[w]})
            if base:
                found += [(k, at, 1.0) for at in votes if at >= 0 and words[at : at + len(template)] == template]
            elif len(mine) >= min(self.rare, len(set(template))) / 2:
                found += self._verified(k, template, key, words, votes, len(mine) / 2)
        return sorted(found, key=lambda x: (x[1], x[0]))

    def _verified(self, k: int, template: list[bytes], key: list[bytes], words: list[bytes], votes: Counter, needed: float) -> list[tuple[int, int, float]]:
        """Places of a template, one for each stretch of the file."""
        out, behind = [], -1
        for at in sorted(votes):
            if at <= behind or sum(votes.get(at + d, 0) for d in range(self.slack + 1)) < needed:
                continue
            share = self._share(template, words, at)
            low, high = max(0, at - self.slack), at + len(template) + self.slack
            if share >= self.coverage and any(words[i : i + len(key)] == key for i in range(low, min(high, len(words)) - len(key) + 1)):
                out.append((k, max(at, 0), share))
                behind = at + len(template) // 2
        return out

    def _share(self, template: list[bytes], words: list[bytes], at: int) -> float:
        """The most template words that can be matched in order where the shift against the file begins at 0 and
        changes within `slack`; a change costs one word."""
        best = {d: 0 if d == 0 else -1 for d in range(-self.slack, self.slack + 1)}
        for j, w in enumerate(template):
            lead = max(best.values()) - 1
            best = {d: max(b, lead) + (0 <= at + j + d < len(words) and words[at + j + d] == w) for d, b in best.items()}
        return max(best.values()) / len(template)


def vocabulary() -> set[bytes]:
    return {w for p in [*BASE, *(t for _, _, t in TEXTS)] for w in words_of(p)}


def scan(docs: DataFrame, keep: list[str], text: str = "text", rare: int = 8, coverage: float = 0.8, slack: int = 4) -> DataFrame:
    """The kept columns and RESULT for every row. Two passes over all texts: document frequencies of the
    templates' words (a fixed, small vocabulary), then the look-up."""
    shared = broadcast(docs.sparkSession, RareTokenIndex(*document_frequencies(docs, vocabulary(), text), rare, coverage, slack))

    def make():
        index = shared.value

        def of(texts):
            rows = []
            for t in texts:
                words = words_of(t)
                found = index.find(words)
                base = [(index.templates[k][2], at) for k, at, _ in found if index.templates[k][3]]
                label = lambda k: index.templates[k][2]
                rows.append((len(words), len(base), min((at for _, at in base), default=None), max((at for _, at in base), default=None), sorted({x for x, _ in base}), sorted({label(k) for k, _, _ in found}), min(1.0, max((s for _, _, s in found), default=0.0)), [{"label": label(k), "word": at, "score": s} for k, at, s in found]))
            return [list(c) for c in zip(*rows)] if rows else [[]] * 8

        return of

    return map_text(docs, keep, RESULT, make, text)
