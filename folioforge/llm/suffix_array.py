"""Suffix arrays by induced sorting, with permuted common prefixes, in NumPy.

The classic scheme: suffixes are of type L or S; leftmost S suffixes (LMS) seed
the order; L suffixes are induced from left to right, S suffixes from right to
left. Both passes go bucket by bucket: all suffixes of one first letter at a
time, in waves where a letter follows itself, which keeps the sequential order
and lets NumPy move whole buckets. LMS substrings get names by their order; if
names repeat, the string of names is sorted first: by the same routine while
its alphabet is small, else by rank doubling of the names not yet apart (buckets
of one or two names would leave nothing to do at once).
"""

from __future__ import annotations

import numpy as np

from folioforge.llm.words import U64, mix, powers

SMALL_ALPHABET = 1024


def _types(t: np.ndarray) -> np.ndarray:
    """True for S suffixes; ``t`` ends in its least, unique letter."""
    step = np.sign(np.diff(t))
    place = np.where(step != 0, np.arange(len(step)), len(step))
    after = np.minimum.accumulate(place[::-1])[::-1]  # next place where letters differ
    return np.append(step[np.minimum(after, len(step) - 1)] > 0, True)


def _spread(queues: list[list], at: np.ndarray, letters: np.ndarray) -> None:
    """Append the places to the queues of their letters, keeping their order."""
    if not len(at):
        return
    order = np.argsort(letters, kind="stable")
    at, letters = at[order], letters[order]
    cuts = np.flatnonzero(np.diff(letters)) + 1
    for part, letter in zip(np.split(at, cuts), letters[np.concatenate([[0], cuts])].tolist()):
        queues[letter].append(part)


def _induce(t: np.ndarray, is_s: np.ndarray, size: int, lms: np.ndarray) -> np.ndarray:
    """The order of all suffixes from LMS places in the order ``lms``."""
    none = np.empty(0, np.int64)
    seeds: list[list] = [[] for _ in range(size)]
    _spread(seeds, lms, t[lms])
    queues: list[list] = [[] for _ in range(size)]
    l_part: list[np.ndarray] = []
    for c in range(size):
        wave, done = (np.concatenate(queues[c]) if queues[c] else none), []
        while len(wave):
            done.append(wave)
            p = wave[wave > 0] - 1
            p = p[~is_s[p]]
            letters = t[p]
            own = letters == c
            _spread(queues, p[~own], letters[~own])
            wave = p[own]
        l_part.append(np.concatenate(done) if done else none)
        if seeds[c]:
            p = np.concatenate(seeds[c])
            p = p[p > 0] - 1
            p = p[~is_s[p]]
            _spread(queues, p, t[p])
    queues = [[] for _ in range(size)]
    queues[int(t[-1])].append(np.array([len(t) - 1]))
    s_part: list[np.ndarray] = [none] * size
    for c in range(size - 1, -1, -1):
        wave, done = (np.concatenate(queues[c]) if queues[c] else none), []
        while len(wave):
            done.append(wave)
            p = wave[wave > 0] - 1
            p = p[is_s[p]]
            letters = t[p]
            own = letters == c
            _spread(queues, p[~own], letters[~own])
            wave = p[own]
        s_part[c] = np.concatenate(done)[::-1] if done else none
        p = l_part[c][::-1]
        p = p[p > 0] - 1
        p = p[is_s[p]]
        _spread(queues, p, t[p])
    return np.concatenate([x for c in range(size) for x in (l_part[c], s_part[c])])


def _by_doubling(names: np.ndarray) -> np.ndarray:
    """Suffix order of a string of names, the last one the least: ranks of
    twice the length each round, for places whose rank is not yet unique."""
    n = len(names)
    rank = np.zeros(2 * n + 1, np.int64)
    order = np.argsort(names, kind="stable")
    first = np.append(True, np.diff(names[order]) != 0)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0)) + 1  # rank: first place of its group
    span = 1
    open_ = order[~(first & np.append(first[1:], True))]
    while len(open_):
        a, b = rank[open_], rank[np.minimum(open_ + span, 2 * n)]
        way = np.lexsort((b, a))
        open_, a, b = open_[way], a[way], b[way]
        new_group = np.append(True, np.diff(a) != 0)
        new = new_group | np.append(True, np.diff(b) != 0)
        at = np.arange(len(open_))
        start = np.maximum.accumulate(np.where(new_group, at, 0))
        sub = np.maximum.accumulate(np.where(new, at, 0))
        rank[open_] = a + (sub - start)
        open_ = open_[~(new & np.append(new[1:], True))]
        span *= 2
    out = np.empty(n, np.int64)
    out[rank[:n] - 1] = np.arange(n)
    return out


def suffix_array(t: np.ndarray, size: int) -> np.ndarray:
    """Suffix order of ``t``: letters below ``size``, the last one the least and unique."""
    t = t.astype(np.int64)
    if len(t) < 3:
        return np.argsort(t, kind="stable")
    is_s = _types(t)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    order = _induce(t, is_s, size, lms)
    mark = np.zeros(len(t), bool)
    mark[lms] = True
    ranked = order[mark[order]]
    # LMS substrings that follow each other in order are equal if length and hash are
    place = np.zeros(len(t), np.int64)
    place[lms] = np.arange(len(lms))
    end = np.append(lms[1:], lms[-1])
    length = (end - lms + 1)[place[ranked]]
    power = powers(len(t) + 1)
    sums = np.append(U64(0), np.cumsum((t + 1).astype(U64) * power[:-1], dtype=U64))
    digest = mix((sums[ranked + length] - sums[ranked]) * power[len(t) - ranked])
    new = np.append(True, (np.diff(length) != 0) | (digest[1:] != digest[:-1]))
    names = np.empty(len(lms), np.int64)
    names[place[ranked]] = np.cumsum(new) - 1
    count = int(new.sum())
    if count < len(lms):
        inner = suffix_array(names, count) if count <= SMALL_ALPHABET else _by_doubling(names)
        ranked = lms[inner]
    return _induce(t, is_s, size, ranked)


def permuted_prefixes(data: np.ndarray, order: np.ndarray, room: np.ndarray) -> np.ndarray:
    """For each place of ``data`` its common prefix with the suffix before it in
    ``order``, at most ``room[place]``. Only places whose letter before differs
    from the one before their neighbour are compared (eight bytes at a time);
    the others have one less than the place before them."""
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((n + 1,), "<u8", buffer=padded.tobytes(), strides=(1,))
    at = np.arange(n)
    known = (before > 0) & (at > 0)
    follows = np.zeros(n, bool)
    k = at[known]
    follows[k] = data[k - 1] == data[before[k] - 1]
    # a place that begins new room cannot follow
    follows[1:] &= room[1:] == room[:-1] - 1
    found = np.zeros(n, np.int64)
    live = at[~follows & (before >= 0)]
    while len(live):
        far = found[live]
        i, j = live + far, before[live] + far
        inside = np.maximum(i, j) < n
        live, i, j = live[inside], i[inside], j[inside]
        differ = words[i] ^ words[j]
        low = differ & (~differ + U64(1))
        same = np.where(differ == 0, 8, np.log2(np.maximum(low, U64(1)).astype(np.float64)).astype(np.int64) >> 3)
        found[live] += same
        live = live[(same == 8) & (found[live] < room[live])]
    found = np.minimum(found, np.minimum(room, n - np.maximum(before, at)))
    base = np.maximum.accumulate(np.where(~follows, at, 0))
    return np.minimum(np.maximum(found[base] - (at - base), 0), room)
