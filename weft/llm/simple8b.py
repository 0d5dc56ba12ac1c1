"""Simple-8b: a 4-bit selector and 60 bits of equally wide ids in every 64-bit word.

Ids are coded in blocks of BLOCK; a block begins at a word, and the offsets of all blocks' first words
stand before the words, so any block is decoded without the others and all blocks together with array
operations. An id of 60 bits set or more is escaped: a word of selector 15 with all 60 bits set, then the
id itself as a whole word.

A file is MAGIC, then as little-endian 64-bit integers the number of ids, of blocks and of escapes, the
blocks' word offsets (one more than blocks), and the words.
"""

from __future__ import annotations

import numpy as np

MAGIC = b"WEFTS8B1"
BLOCK = 240
#: Ids in a word and bits of each, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = (1 << 60) - 1
U = np.uint64


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits of every id."""
    width = np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    big = np.flatnonzero(ids >= U(1 << 53))  # those that a double may round up
    if len(big):
        width[big] = 32 + np.frexp((ids[big] >> U(32)).astype(np.float64))[1]
    return width


def encode(ids: np.ndarray) -> bytes:
    """The file of an array of unsigned integers below 2**64."""
    ids = np.asarray(ids, U)
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    padded = np.zeros(blocks * BLOCK, U)
    padded[:n] = ids
    wide = padded >= U(ESCAPE)
    width = _widths(padded)
    width[wide] = 60
    # Largest width in the next 2^k ids of the block; past its end there is nothing to hold.
    rows = np.zeros((blocks, 2 * BLOCK), np.uint8)
    rows[:, :BLOCK] = width.reshape(blocks, BLOCK)
    most = {1: rows}
    for k in (1, 2, 4, 8, 16, 32, 64):
        most[2 * k] = np.maximum(most[k], np.pad(most[k][:, k:], ((0, 0), (0, k))))
    best = np.full((blocks, BLOCK), 15, np.uint8)
    for s in range(14, -1, -1):
        count, p = int(COUNTS[s]), 1 << (int(COUNTS[s]).bit_length() - 1)
        top = np.maximum(most[p][:, :BLOCK], most[p][:, count - p : count - p + BLOCK])
        best -= top <= BITS[s]  # what fits a selector fits all after it
    # All blocks step from word to word together.
    sizes = np.minimum(BLOCK, n - BLOCK * np.arange(blocks))
    alive, cursor, steps = np.arange(blocks), np.zeros(blocks, np.int64), []
    words_of = np.zeros(blocks, np.int64)
    while len(alive):
        sel = best[alive, cursor[alive]]
        first = alive * BLOCK + cursor[alive]
        extra = (sel == 15) & wide[first]
        steps.append((alive, words_of[alive], first, sel, extra))
        words_of[alive] += 1 + extra
        cursor[alive] += COUNTS[sel]
        alive = alive[cursor[alive] < sizes[alive]]
    offsets = np.concatenate([[0], np.cumsum(words_of)])
    words = np.zeros(int(offsets[-1]), U)
    padded = np.concatenate([padded, np.zeros(BLOCK, U)])
    if steps:
        block, index, first, sel, extra = (np.concatenate(x) for x in zip(*steps))
        at, limit = offsets[block] + index, (block + 1) * BLOCK
        for s in range(16):
            pick = np.flatnonzero(sel == s)
            word = np.full(len(pick), s << 60, U)
            for k in range(int(COUNTS[s]) if BITS[s] else 0):
                i = first[pick] + k
                value = np.where(i < limit[pick], padded[np.minimum(i, len(padded) - 1)], U(0))
                word |= np.where(extra[pick], U(ESCAPE), value) << U(k * int(BITS[s]))
            words[at[pick]] = word
        words[at[extra] + 1] = padded[first[extra]]
    head = np.array([n, blocks, int(wide.sum())], "<u8").tobytes()
    return MAGIC + head + offsets.astype("<u8").tobytes() + words.astype("<u8").tobytes()


def decode(data: bytes) -> np.ndarray:
    """The ids of a file, as unsigned 64-bit integers."""
    if data[:8] != MAGIC:
        raise ValueError("not a Simple-8b file")
    n, blocks, escapes = (int(x) for x in np.frombuffer(data, "<u8", 3, 8))
    offsets = np.frombuffer(data, "<u8", blocks + 1, 32).astype(np.int64)
    words = np.frombuffer(data, "<u8", int(offsets[-1]), 32 + 8 * (blocks + 1))
    sel = (words >> U(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    if escapes:
        last = -2
        for i in np.flatnonzero(words == U((15 << 60) | ESCAPE)).tolist():
            if i != last + 1:
                raw[i + 1], last = True, i
    counts = np.where(raw, 0, COUNTS[sel])
    block = np.repeat(np.arange(blocks), np.diff(offsets))
    ends = np.cumsum(counts)
    start = ends - counts
    first = block * BLOCK + start - start[offsets[:-1]][block] if len(words) else start
    out = np.zeros((blocks + 1) * BLOCK, U)
    for s in range(16):
        if not BITS[s]:
            continue
        pick = np.flatnonzero((sel == s) & ~raw)
        mask = U((1 << int(BITS[s])) - 1)
        for k in range(int(COUNTS[s])):
            i = first[pick] + k
            inside = i < (block[pick] + 1) * BLOCK
            out[i[inside]] = (words[pick[inside]] >> U(k * int(BITS[s]))) & mask
    if escapes:
        at = np.flatnonzero(raw)
        out[first[at - 1]] = words[at]
    return out[:n]
