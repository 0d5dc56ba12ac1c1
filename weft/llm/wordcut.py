"""Words (runs of letters) of many texts at once, as 64-bit hashes, with array operations over UTF-8 bytes."""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa

U = np.uint64
WORD = re.compile(r"[^\W\d_]+")
RATIO = 0xD1342543DE82EF95
MIX = [U(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mixed(h: np.ndarray, salt: int) -> np.ndarray:
    h = h ^ U(salt * 0x2545F4914F6CDD1D & (1 << 64) - 1)
    h = (h ^ (h >> U(30))) * MIX[1]
    h = (h ^ (h >> U(27))) * MIX[2]
    return h ^ (h >> U(31))


@cache
def letters() -> np.ndarray:
    """By code point below 2**16 and for all beyond: whether it belongs to words."""
    return np.array([WORD.match(chr(c)) is not None for c in range(1 << 16)])


@cache
def values() -> np.ndarray:
    return np.random.default_rng(2024).integers(0, 1 << 64, 256, dtype=U)


_POWERS = [np.ones(1, U), np.ones(1, U)]


def powers(size: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < size:
        for k, r in enumerate((RATIO, pow(RATIO, -1, 1 << 64))):
            _POWERS[k] = np.concatenate([np.ones(1, U), np.full(max(size, 1 << 19) - 1, r, U).cumprod(dtype=U)])
    return _POWERS


def hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of raw[start:end], from sums over all of raw; places from 1 on."""
    power, inverse = powers(len(raw))
    total = np.cumsum(values()[raw] * power[: len(raw)], dtype=U)
    return mixed((total[end - 1] - total[start - 1]) * inverse[start], 1)


def runs(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of letters in UTF-8 bytes that begin and end with a blank."""
    kind = np.zeros(len(raw), bool)
    ascii_ = letters()[:128]
    kind[:] = np.concatenate([ascii_, np.zeros(128, bool)])[raw]
    for first, last, more in ((0xC0, 0xE0, 1), (0xE0, 0xF0, 2), (0xF0, 0x100, 3)):
        at = np.flatnonzero((raw >= first) & (raw < last)) if raw.max(initial=0) >= first else np.zeros(0, np.int64)
        if not len(at):
            continue
        code = (raw[at] & (0x3F >> more)).astype(np.int64)
        for k in range(1, more + 1):
            code = code << 6 | (raw[at + k] & 0x3F)
        if more < 3:
            is_letter = letters()[code]
        else:
            is_letter = np.array([WORD.match(chr(c)) is not None for c in code.tolist()], bool)
        for k in range(more + 1):
            kind[at + k] = is_letter
    change = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    return change[::2], change[1::2]


def words(texts: list[str | None], most: int = 1 << 19):
    """Stretches of the lower-cased texts: (raw bytes, starts and ends of words, their hashes, the text that
    each is of). Texts are cut into stretches of about `most` bytes at blanks."""
    held, owner, size = [], [], 0

    def flush():
        raw = np.frombuffer(b"\n".join([b"", *held, b""]), np.uint8)
        start, end = runs(raw)
        begin = np.cumsum([1] + [len(h) + 1 for h in held])
        of = np.array(owner, np.int64)[np.searchsorted(begin, start, side="right") - 1] if len(start) else start
        return raw, start, end, hashes(raw, start, end) if len(start) else np.zeros(0, U), of

    for i, t in enumerate(texts):
        if not t:
            continue
        data, at = t.lower().encode("utf-8", "surrogatepass"), 0
        while at < len(data):
            stop = len(data)
            if stop - at > most:
                stop = data.rfind(b" ", at, at + most)
                stop = stop + 1 if stop > at else (data.find(b" ", at + most) + 1 or len(data))
            held.append(data[at:stop])
            owner.append(i)
            size += stop - at
            at = stop
            if size >= most:
                yield flush()
                held, owner, size = [], [], 0
    if held:
        yield flush()


class Rows:
    """Numbers 0, 1, ... by 64-bit hash, in an open-addressed table."""

    def __init__(self, hashes: np.ndarray | None = None):
        self.keys, self.table, self.n = np.zeros(1 << 12, U), np.full(1 << 14, -1, np.int32), 0
        if hashes is not None and len(hashes):
            self.add(hashes)

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return ((h * MIX[0]) >> U(65 - len(self.table).bit_length())).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        slot = self._slot(h)
        found = self.table.take(slot)
        odd = np.flatnonzero((self.keys.take(found, mode="wrap") != h) & (found >= 0))
        while len(odd):
            slot[odd] = (slot[odd] + 1) & (len(self.table) - 1)
            found[odd] = self.table[slot[odd]]
            odd = odd[(self.keys.take(found[odd], mode="wrap") != h[odd]) & (found[odd] >= 0)]
        return found

    def _place(self, entries: np.ndarray) -> None:
        slot = self._slot(self.keys[entries])
        while len(entries):
            free = self.table[slot] < 0
            self.table[slot[free]] = entries[free]
            left = self.table[slot] != entries
            entries, slot = entries[left], (slot[left] + 1) & (len(self.table) - 1)

    def add(self, new: np.ndarray) -> None:
        """Distinct hashes that are not there yet get the next numbers."""
        entries = np.arange(self.n, self.n + len(new), dtype=np.int32)
        self.n += len(new)
        while self.n > len(self.keys):
            self.keys = np.concatenate([self.keys, np.zeros_like(self.keys)])
        self.keys[entries] = new
        if 2 * self.n > len(self.table):
            size = len(self.table)
            while 2 * self.n > size:
                size *= 2
            self.table, entries = np.full(size, -1, np.int32), np.arange(self.n, dtype=np.int32)
        self._place(entries)
