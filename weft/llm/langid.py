"""Language identification by words first, with backoff to shorter character n-grams.

Training counts words by language in a sample of labelled rows of bounded size, as many of each language; a known
word scores by its log frequency in each language. An unseen word is scored character by character with
the longest n-gram known in any language, falling back from 5 characters to 1, each step down at a fixed
penalty. Words and n-grams are known by 64-bit hashes, looked up for a whole batch at a time; all words of
the sample are kept. `known` is the share of a text's words that the sample holds.

Defined results: a null text and one without letters give `und` with score 0; without labelled rows
every text gives `und`; repeated rows and ids each get their own row; null ids pass through; an empty
table gives an empty result; columns not kept are dropped. Texts are used whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm import wordcut
from weft.llm.arrowmap import arrow_schema, broadcast, map_text, trim
from weft.llm.wordcut import Rows, U, mixed
from weft.session import ship

UNKNOWN = "und"


#: Words whose n-grams are counted at once.
SOME_WORDS = 30_000


def grams(words: list[str], n_max: int):
    """For n from 1 to n_max: the hash of the n characters that end at each place of the words, each between
    blanks, and whether n characters of the word end there."""
    sizes = places(words)
    text = np.frombuffer("".join(f" {w} " for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(U)
    at = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    h = np.zeros(len(text), U)
    for n in range(1, n_max + 1):
        h = mixed((np.concatenate([h[:1], h[:-1]]) if n > 1 else h) * wordcut.MIX[0] + text, n)
        yield h, at >= n - 1


def places(words: list[str]) -> np.ndarray:
    return np.array([len(w) + 2 for w in words], np.int64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their rows of counts."""
    distinct, index = np.unique(keys, return_inverse=True)
    return distinct, np.stack([np.bincount(index, counts[:, c], len(distinct)) for c in range(counts.shape[1])], axis=1)


class WordBackoffModel:
    """Log frequencies of words and n-grams by language. A gram's log frequency is relative to its order's
    total; all grams of the sample are kept, so an unseen word finds at least its letters."""

    def __init__(self, counts: pa.Table, n_max: int = 5, penalty: float = math.log(0.4)):
        """counts: lang, word, n; words stay in Arrow, and only some at a time become Python strings."""
        lang, word = (counts.column(c).cast(pa.large_string()).combine_chunks().dictionary_encode() for c in ("lang", "word"))
        names = lang.dictionary.to_pylist()
        self.langs = sorted(names)
        self.n_max, self.penalty, k = n_max, penalty, max(len(names), 1)
        column = np.array([self.langs.index(x) for x in names], np.int64)
        table = np.zeros((len(word.dictionary), k))
        if len(word):
            np.add.at(table, (word.indices.to_numpy(), column[lang.indices.to_numpy()]), counts.column("n").to_numpy())
        words = word.dictionary
        hashes = [self._hashes(words.slice(at, SOME_WORDS).to_pylist()) for at in range(0, len(words), SOME_WORDS)]
        self.words, self.grams, scores = Rows(np.concatenate([np.zeros(0, U), *hashes])), Rows(), [self._logs(table, table.sum(axis=0))]
        for n in range(1, n_max + 1 if len(words) else 1):  # one order at a time: they take most of the room
            parts = []
            for first in range(0, len(words), SOME_WORDS):
                some = words.slice(first, SOME_WORDS).to_pylist()
                owner = first + np.repeat(np.arange(len(some)), places(some))
                *_, (h, whole) = grams(some, n)
                parts.append(summed(h[whole], table[owner[whole]]))
            keys, total = summed(*(np.concatenate(x) for x in zip(*parts)))
            self.grams.add(keys)
            scores.append(self._logs(total, total.sum(axis=0)))
        self.word_scores, self.gram_scores = scores[0], np.concatenate([np.zeros((0, k), "f4"), *scores[1:]])

    @staticmethod
    def _hashes(words: list[str]) -> np.ndarray:
        raw = np.frombuffer(b"\n".join([b"", *(w.encode("utf-8", "surrogatepass") for w in words), b""]), np.uint8)
        edges = np.flatnonzero(raw == 10)
        return wordcut.hashes(raw, edges[:-1] + 1, edges[1:]) if words else np.zeros(0, U)

    @staticmethod
    def _logs(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
        return np.log((counts + 0.1) / (totals + 1)).astype("f4")

    def unseen(self, words: list[str]) -> np.ndarray:
        """Scores of words by their n-grams."""
        orders, sizes = list(grams(words, self.n_max)), places(words)
        out = np.zeros((int(sizes.sum()), max(len(self.langs), 1)), "f4")
        left = np.arange(len(out))
        for n in range(self.n_max, 0, -1):
            h, whole = orders[n - 1]
            found = np.where(whole[left], self.grams.find(h[left]), -1)
            hit = found >= 0
            out[left[hit]] = self.gram_scores[found[hit]] + np.float32(self.penalty * (self.n_max - n))
            left = left[~hit]
        return np.add.reduceat(out, np.cumsum(sizes) - sizes, axis=0, dtype="f8").astype("f4") / np.float32(self.n_max)


def word_counts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    ship(docs.sparkSession)
    schema = arrow_schema("lang string, word string, n long")

    def count(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                langs = part.column(0).to_pylist()
                names = sorted(set(langs))
                codes = np.array([names.index(x) for x in langs], np.int64)
                for raw, start, end, h, of in wordcut.words(part.column(1).to_pylist()):
                    code = codes[of]
                    _, first, n = np.unique(mixed(h, 7) ^ code.astype(U), return_index=True, return_counts=True)
                    text = [raw[s:e].tobytes().decode("utf-8", "surrogatepass") for s, e in zip(start[first].tolist(), end[first].tolist())]
                    keep = [i for i, w in enumerate(text) if any(c.isalpha() for c in w)]
                    values = ([names[code[first[i]]] for i in keep], [text[i] for i in keep], n[keep])
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)
        trim()

    return docs.select(F.col(f"`{lang}`").cast("string"), F.col(f"`{text}`").cast("string")).mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, id: str = "doc_id", lang: str = "lang", text: str = "text", sample_docs: int = 8000) -> WordBackoffModel:
    """A model of about `sample_docs` rows with a language, the same number of each language as far as it
    has them, at every input size. Each row is chosen by itself, by a hash of its id, its text and its place
    in the input: neither rows without an id nor copies enter together. All words of the sample are kept; the
    numbers of rows by language and the sample's words reach the driver."""
    rows = labelled.filter(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull())
    sizes = {r["l"]: r["n"] for r in rows.groupBy(F.col(f"`{lang}`").cast("string").alias("l")).agg(F.count("*").alias("n")).collect()}
    share, left = 0, sample_docs
    for k, n in enumerate(sorted(sizes.values())):  # what small languages leave goes to the others
        share = left / (len(sizes) - k)
        left -= min(n, share)
    if any(n > share for n in sizes.values()):
        bound = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, int((1 << 31) * min(1.0, share / n)))])
        placed = rows.withColumn("_weft_place", F.monotonically_increasing_id())
        chance = F.pmod(F.xxhash64(F.col(f"`{id}`").cast("string"), F.col(f"`{text}`").cast("string"), F.col("_weft_place")), F.lit(1 << 31))
        rows = placed.filter(chance < bound[F.col(f"`{lang}`").cast("string")])
    model = WordBackoffModel(word_counts(rows, lang, text).toArrow())
    trim()
    return model


class Scorer:
    """A worker's model with the scores of words met since."""

    def __init__(self, model: WordBackoffModel, memo_words: int):
        self.model, self.memo_words = model, memo_words
        self._empty()

    def _empty(self) -> None:
        m = self.model
        self.rows = Rows(m.words.keys[: m.words.n])
        self.scores = m.word_scores

    def find(self, raw, start, end, h) -> np.ndarray:
        at = self.rows.find(h)
        new = np.flatnonzero(at < 0)
        if len(new):
            keys, first = np.unique(h[new], return_index=True)
            one = new[first]
            words = [raw[s:e].tobytes().decode("utf-8", "surrogatepass") for s, e in zip(start[one].tolist(), end[one].tolist())]
            scores = self.model.unseen(words)
            for i, w in enumerate(words):  # numerals that are no letters say nothing, as text without letters
                if not w.isalpha() and not any(c.isalpha() for c in w):
                    scores[i] = np.nan
            need = self.rows.n + len(keys)
            if need > len(self.scores):
                self.scores = np.concatenate([self.scores[: self.rows.n], np.zeros((max(need, 1 << 16), self.scores.shape[1]), "f4")])
            self.scores[self.rows.n : need] = scores
            self.rows.add(keys)
            at[new] = self.rows.find(h[new])
        return at

    def __call__(self, texts: list[str | None]) -> list[list]:
        m, k = self.model, len(self.model.langs)
        total, count, known = np.zeros((len(texts), max(k, 1))), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for raw, start, end, h, of in wordcut.words(texts) if k else ():
            if not len(h):
                continue
            at = self.find(raw, start, end, h)
            scores = self.scores[at].astype("f8")
            real = ~np.isnan(scores[:, 0])
            scores, of, at = scores[real], of[real], at[real]
            for c in range(k):
                total[:, c] += np.bincount(of, scores[:, c], len(texts))
            count += np.bincount(of, minlength=len(texts))
            known += np.bincount(of[at < m.words.n], minlength=len(texts))
            if self.rows.n > m.words.n + self.memo_words:
                self._empty()
        p = np.exp(total - total.max(axis=1, keepdims=True))
        best, some = total.argmax(axis=1), count > 0
        score = np.where(some, p.max(axis=1) / p.sum(axis=1), 0.0)
        share = np.where(some, known / np.maximum(count, 1), 0.0)
        return [[m.langs[b] if s else UNKNOWN for b, s in zip(best.tolist(), some.tolist())], score, share]


def identify(docs: DataFrame, model: WordBackoffModel, keep: list[str], text: str = "text", memo_words: int = 250_000) -> DataFrame:
    """The kept columns, `lang_pred`, `score` (the posterior of the language) and `known` (the share of words
    that the sample holds) for every row. A task's memory holds the model and the scores of at most about
    `memo_words` further words."""
    shared = broadcast(docs.sparkSession, model)
    return map_text(docs, keep, "lang_pred string, score double, known double", lambda: Scorer(shared.value, memo_words), text)
