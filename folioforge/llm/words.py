"""Word hashes of whole Arrow batches, in NumPy.

Texts are taken as UTF-8 bytes in chunks of about ``CHUNK`` bytes (a longer
text is a chunk of its own), so memory follows the chunk, not the batch. The
result of a chunk is flat: one 64-bit hash per word and the first word of each
text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: bytes that end a word: white space only, or all that is neither letter, digit nor non-ASCII
WHITE_BYTES = np.zeros(256, bool)
WHITE_BYTES[[9, 10, 11, 12, 13, 32]] = True
PUNCT_BYTES = np.ones(256, bool)
PUNCT_BYTES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    h = h ^ (h >> U64(29))
    h = h * U64(0xA0761D6478BD642F)
    return h ^ (h >> U64(32))


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    p = np.full(max(n, 1), base, U64)
    p[0] = 1
    return np.cumprod(p, dtype=U64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and its n+1 offsets; null texts are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    start, end = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    return whole[start:end], offsets.astype(np.int64) - start


def chunks(offsets: np.ndarray, size: int = CHUNK):
    """(first, last) text ranges of about ``size`` bytes each."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_hashes(data: np.ndarray, offsets: np.ndarray, ends_word: np.ndarray = WHITE_BYTES, cut: int | None = None):
    """(hashes, first): a hash per word of the texts data[offsets[i]:offsets[i+1]],
    A-Z lower-cased; text i has the words first[i]..first[i+1]-1. With ``cut`` a
    longer word counts as its first ``cut`` bytes."""
    if not len(data):
        return np.empty(0, U64), np.zeros(len(offsets), np.int64)
    inside = ~ends_word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    at = np.flatnonzero(starts)
    first = np.searchsorted(at, offsets).astype(np.int64)
    if not len(at):
        return np.empty(0, U64), first
    run = np.cumsum(inside)
    begin = run[at] - 1  # place of each word in the bytes of all words
    length = np.diff(np.append(begin, run[-1]))
    place = np.arange(int(run[-1])) - np.repeat(begin, length)
    values = _LOWER[data[inside]].astype(U64) + U64(1)
    values *= powers(int(length.max()))[place]
    if cut is not None:
        values[place >= cut] = 0
        length = np.minimum(length, cut)
    return mix(np.add.reduceat(values, begin) + length.astype(U64)), first


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of words i..i+n-1 for each i, over text borders too."""
    if len(words) < n:
        return np.empty(0, U64)
    out = np.zeros(len(words) - n + 1, U64)
    for k in range(n):
        out = (out + words[k:len(words) - n + 1 + k]) * U64(0xE7037ED1A0B428DB + 2 * k)
    return mix(out)
