"""Token ids of whole texts by a public tokenizer file, many texts at once.

The tokenizer of ``word_bpe_49k.json`` lower-cases, drops white space, cuts a text into pre-tokens, and
encodes each by itself. Texts whose characters all have a class below (U+0001 to U+012F but for a few,
and common punctuation) are cut here by the same rule with array operations over the bytes of a whole
batch. A pre-token is looked up by its bytes, all of them compared, in a table of those met before; only
new ones go to the library, many at a time. All other texts, and all texts of any other tokenizer file,
go to the library whole.

A worker holds at most `memo_words` pre-tokens, and is emptied beyond them; a batch is worked on in
stretches of about CHUNK bytes that end at white space, so one very long text needs no more memory than
many short ones (but for its ids).
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19
U = np.uint64
SPACE, LETTER, NUMBER, OTHER, LEAD, THREE, REST, WHOLE = range(8)
#: First bytes of two-byte characters below U+0140, and the pairs after 0xE2 of punctuation that is the
#: same in every version of Unicode: U+2010 to U+2027 and the euro sign.
LEADS = (0xC2, 0xC3, 0xC4)
PUNCTUATION = [0x8000 + last for last in range(0x90, 0xA8)] + [0x82AC]


def _kind(code: int) -> int:
    if code in (0, 0x1C, 0x1D, 0x1E, 0x1F, 0x85) or code >= 0x130:  # taken for white space by some only
        return WHOLE
    char = chr(code)
    return SPACE if char.isspace() else {"L": LETTER, "N": NUMBER}.get(unicodedata.category(char)[0], OTHER)


KINDS = np.array([_kind(c) for c in range(0x140)], np.uint8)
BYTES = np.full(256, WHOLE, np.uint8)
BYTES[:0x80], BYTES[list(LEADS)], BYTES[0xE2], BYTES[0x80:0xC0] = KINDS[:0x80], LEAD, THREE, REST
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: What lower-casing adds to a two-byte character; none below U+0130 gets another first byte.
SHIFT = np.array([ord(chr(c).lower()) - c if 0x80 <= c < 0x130 else 0 for c in range(0x140)], np.uint8)
MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], U)
#: Contractions, after the apostrophe.
ONE_LETTER, TWO_LETTERS = b"stmd", (b"re", b"ve", b"ll")


class Memo:
    """Ids by pre-token. Those of up to 16 bytes stand in an open-addressed table under their two words."""

    def __init__(self):
        self.table = np.full(1 << 16, -1, np.int32)
        self.n = self.used = 0
        self.words = np.zeros((1 << 12, 2), U)
        self.span = np.zeros(1 << 12, np.int64)  # place of the first id, and 31 bits of their number
        self.ids = np.zeros(1 << 14, "<u4")
        self.long: dict[bytes, int] = {}

    @staticmethod
    def hashed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        h = a * U(0x9E3779B97F4A7C15) + (b ^ U(0xD6E8FEB86659FD93)) * U(0xBF58476D1CE4E5B9)
        h ^= h >> U(32)
        return h * U(0x94D049BB133111EB)

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h >> U(65 - len(self.table).bit_length())).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Entries of pre-tokens; -1 where there is none."""
        slot = self._slot(h)
        found = self.table.take(slot)
        words = self.words.take(found, axis=0, mode="wrap")
        odd = np.flatnonzero(((words[:, 0] != a) | (words[:, 1] != b)) & (found >= 0))
        while len(odd):  # another one's place: look in the next
            slot[odd] = (slot[odd] + 1) & (len(self.table) - 1)
            there = self.table[slot[odd]]
            found[odd] = there
            odd = odd[(there >= 0) & ((self.words[there, 0] != a[odd]) | (self.words[there, 1] != b[odd]))]
        return found

    def _place(self, entries: np.ndarray) -> None:
        slot = self._slot(self.hashed(self.words[entries, 0], self.words[entries, 1]))
        while len(entries):
            free = self.table[slot] < 0
            self.table[slot[free]] = entries[free]
            left = self.table[slot] != entries
            entries, slot = entries[left], (slot[left] + 1) & (len(self.table) - 1)

    def add(self, counts: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """New entries with their ids, one after another."""
        new = np.arange(self.n, self.n + len(counts))
        while self.n + len(counts) > len(self.span):
            self.words, self.span = (np.concatenate([x, np.zeros_like(x)]) for x in (self.words, self.span))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.span[new] = (self.used + np.cumsum(counts) - counts) << 31 | counts
        self.ids[self.used : self.used + len(ids)] = ids
        self.n, self.used = self.n + len(counts), self.used + len(ids)
        return new

    def index(self, new: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """Entries new become known under their words."""
        self.words[new, 0], self.words[new, 1] = a, b
        if 2 * self.n > len(self.table):
            everyone = self.table[self.table >= 0]
            size = len(self.table)
            while 2 * self.n > size:
                size *= 2
            self.table = np.full(size, -1, np.int32)
            self._place(everyone)
        self._place(new.astype(np.int32))


class Encoder:
    def __init__(self, path: str, memo_words: int = 1_000_000, word_level: bool | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.pieces = Tokenizer.from_file(path)  # for pre-tokens with spaces between
        self.memo_words = memo_words
        self.memo = Memo()
        if word_level is None:
            import json

            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            word_level = spec["model"].get("end_of_word_suffix") == "</w>" and '"Removed"' in json.dumps(spec.get("pre_tokenizer"))
        self.word_level = word_level
        self.ends = np.zeros(max(self.library.get_vocab().values()) + 1, bool)
        if word_level:
            from tokenizers import pre_tokenizers

            self.pieces.normalizer = None
            self.pieces.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            for piece, i in self.library.get_vocab().items():
                self.ends[i] = piece.endswith("</w>")

    def _whole(self, text: str | None) -> np.ndarray:
        return np.array(self.library.encode(text or "", add_special_tokens=False).ids, "<u4")

    def _learn(self, new: list[bytes]) -> np.ndarray:
        """Entries of new pre-tokens: of many in one text, for the last id of each is known by its word end."""
        made = []
        for at in range(0, len(new), 200):
            group = [p.decode() for p in new[at : at + 200]]
            ids = np.array(self.pieces.encode_batch_fast([" ".join(group)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(group):
                counts = np.diff(ends, prepend=0)
            else:
                each = [np.array(e.ids, "<u4") for e in self.pieces.encode_batch_fast(group, add_special_tokens=False)]
                counts, ids = np.array([len(e) for e in each]), np.concatenate(each)
            made.append(self.memo.add(counts, ids))
        return np.concatenate(made)

    def _entries(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The memo's entry of every pre-token raw[start:end]; raw goes on for 16 bytes."""
        memo, size = self.memo, end - start
        words = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
        a = words[start] & MASK[np.minimum(size, 8)]
        b = words[start + 8] & MASK[np.clip(size - 8, 0, 8)]
        h = memo.hashed(a, b)
        found = memo.find(a, b, h)
        long = np.flatnonzero(size > 16)
        if len(long):
            texts = [raw[s:e].tobytes() for s, e in zip(start[long].tolist(), end[long].tolist())]
            new = [t for t in dict.fromkeys(texts) if t not in memo.long]
            if new:
                memo.long.update(zip(new, self._learn(new).tolist()))
            found[long] = [memo.long[t] for t in texts]
        left = np.flatnonzero(found < 0)
        while len(left):
            _, first = np.unique(h[left], return_index=True)
            one = left[first]
            new = self._learn([raw[s:e].tobytes() for s, e in zip(start[one].tolist(), end[one].tolist())])
            memo.index(new, a[one], b[one])
            found[left] = memo.find(a[left], b[left], h[left])
            left = left[found[left] < 0]
        return found

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many of them each text has; a null text counts
        as empty."""
        texts = column.cast(pa.large_binary()).fill_null(b"")
        n = len(texts)
        if not n:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        if not self.word_level:
            each = [np.array(e.ids, "<u4") for e in self.library.encode_batch_fast([t or "" for t in column.to_pylist()], add_special_tokens=False)]
            return np.concatenate(each), np.array([len(e) for e in each], np.int64)
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64, n + 1, 8 * texts.offset)
        body = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        # A line end before each text and after the last keeps them apart.
        begin = offsets[:-1] + np.arange(1, n + 1)
        text = np.full(len(body) + n + 1 + 24, 10, np.uint8)
        place = np.ones(len(body) + n + 1, bool)
        place[begin - 1] = place[-1] = False
        text[: len(place)][place] = body
        del place
        end, out, lengths, at, odd = len(body) + n + 1, [], np.zeros(n, np.int64), 0, set()
        while at < end:
            stop = min(at + CHUNK, end)
            if stop < end:  # behind white space: the last in this stretch, or the next there is
                near = np.flatnonzero(text[at:stop] == 32)
                if not len(near):
                    near = np.flatnonzero(text[at:stop] == 10)
                    near = near[near > 0]
                if len(near):
                    stop = at + int(near[-1]) + 1
                else:
                    gap = stop
                    while gap < end and text[gap] not in (10, 32):
                        gap += 1
                    stop = gap + 1
            start, ends, bad = cut(text[at : stop + 24])
            if len(bad):
                odd.update((np.searchsorted(begin, bad + at, side="right") - 1).tolist())
            entries = self._entries(text[at : stop + 24], start, ends)
            span = self.memo.span.take(entries)
            counts, first = span & 0x7FFFFFFF, span >> 31
            total = np.cumsum(counts)
            out.append(self.memo.ids[np.repeat(first - (total - counts), counts) + np.arange(int(total[-1]) if len(total) else 0)])
            cuts = np.searchsorted(start + at, begin)
            sums = np.concatenate([[0], total])
            lengths += np.diff(np.append(sums[cuts], sums[-1]))
            if self.memo.n > self.memo_words:
                self.memo = Memo()
            at = stop
        ids = np.concatenate(out)
        if not odd:
            return ids, lengths
        each = np.split(ids, np.cumsum(lengths)[:-1])
        for i in odd:
            each[i] = self._whole(column[i].as_py())
        return np.concatenate(each), np.array([len(e) for e in each], np.int64)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """One array of little-endian 32-bit ids a text."""
        ids, lengths = self.encode_column(pa.array(texts, pa.string()))
        return np.split(ids, np.cumsum(lengths)[:-1]) if len(lengths) else []


def cut(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last places of the pre-tokens of a stretch that begins and ends (24 places before the end
    of the array) at white space, lower-cased in place; and places of characters without a class here."""
    n = len(text) - 24
    raw = text[:n]
    kind = BYTES.take(raw)
    raw[:] = LOWER.take(raw)
    lead = np.flatnonzero(kind == LEAD)
    if len(lead):
        code = ((text[lead] & 0x1F).astype(np.int64) << 6) | (text[lead + 1] & 0x3F)
        of = KINDS[code]
        kind[lead], kind[lead + 1] = of, np.where(of == NUMBER, REST, of)
        text[lead + 1] += SHIFT[code]
    three = np.flatnonzero(kind == THREE)
    if len(three):
        pair = (text[three + 1].astype(np.int64) << 8) | text[three + 2]
        fine = np.isin(pair, PUNCTUATION)
        kind[three] = np.where(fine, OTHER, WHOLE)
        kind[three[fine] + 1] = kind[three[fine] + 2] = OTHER
    bad = np.flatnonzero(kind == WHOLE)
    special = np.flatnonzero(raw == 60)
    if len(special):  # <| may begin a special token
        bad = np.concatenate([bad, special[text[special + 1] == 124]])
    change = np.empty(n, bool)
    change[0] = kind[0] != SPACE
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    change |= kind == NUMBER
    change &= kind != REST
    edge = np.flatnonzero(change)
    real = kind[edge] != SPACE
    start, end = edge[real], np.append(edge[1:], n)[real]
    short = np.flatnonzero((text[start] == 39) & (end - start == 1))
    if len(short):
        next_, after = text[start[short] + 1], text[start[short] + 2]
        size = np.where(np.isin(next_, list(ONE_LETTER)), 2, 1)
        for x, y in TWO_LETTERS:
            size[(next_ == x) & (after == y)] = 3
        short, size = short[size > 1], size[size > 1]
        end[short] = start[short] + size
        start[short + 1] += size - 1
        keep = start < end
        start, end = start[keep], end[keep]
    return start, end, bad


def with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of encode_column with an end id behind each text's, and the lengths with it."""
    ends = np.cumsum(lengths + 1)
    out = np.empty(len(ids) + len(lengths), "<u4")
    place = np.ones(len(out), bool)
    place[ends - 1] = False
    out[place], out[ends - 1] = ids, end_id
    return out, lengths + 1


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file, kept for its next tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
