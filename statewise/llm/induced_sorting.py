"""Suffix arrays by induced sorting, permuted common prefixes, and the strings that begin in more than one place."""

from __future__ import annotations

import numpy as np

#: Up to so many different symbols are induced bucket by bucket in array operations, more one suffix at a time.
BUCKETED = 1024


def smaller_type(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; ``s`` ends with its only least symbol."""
    n = len(s)
    step = np.sign(np.diff(s.astype(np.int64)))
    at = np.where(step != 0, np.arange(n - 1), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    return np.r_[step[np.minimum(at, n - 2)] > 0, True]


def _append(sa: np.ndarray, place: np.ndarray, s: np.ndarray, found: np.ndarray, step: int) -> None:
    """Puts suffixes, in order, at the next free places of their symbols' buckets."""
    if not len(found):
        return
    symbols = s[found]
    order = np.argsort(symbols, kind="stable")
    symbols, found = symbols[order], found[order]
    first = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
    sizes = np.diff(np.r_[first, len(found)])
    sa[place[symbols] + step * (np.arange(len(found)) - np.repeat(first, sizes))] = found
    place[symbols[first]] += step * sizes


def induce(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """All suffixes in the order that follows from ``lms``, the order of the leftmost-smaller ones.

    They stand at the ends of their symbols' buckets; one scan upwards places the larger suffixes after their
    successors, one scan downwards the smaller ones.
    """
    if k > BUCKETED:
        return _induce_one_by_one(s, smaller, lms, k)
    n = len(s)
    sizes = np.bincount(s, minlength=k)
    end = np.cumsum(sizes)
    start = end - sizes
    of_lms = np.bincount(s[lms], minlength=k)
    by_symbol = lms[np.argsort(s[lms], kind="stable")]
    to = np.cumsum(of_lms)
    sa = np.full(n, -1, np.int64)
    place = start.copy()
    for c in np.flatnonzero(sizes).tolist():
        scanned, done = [], int(start[c])
        while place[c] > done:
            before = sa[done : place[c]] - 1
            done = int(place[c])
            before = before[before >= 0]
            before = before[~smaller[before]]
            same = s[before] == c
            _append(sa, place, s, before[same], 1)
            scanned.append(before[~same])
        before = by_symbol[to[c] - of_lms[c] : to[c]] - 1
        before = before[before >= 0]
        scanned.append(before[~smaller[before]])
        _append(sa, place, s, np.concatenate(scanned), 1)
    larger = place
    place = end - 1
    for c in np.flatnonzero(sizes)[::-1].tolist():
        scanned, done = [], int(end[c]) - 1
        while place[c] < done:
            before = sa[place[c] + 1 : done + 1][::-1] - 1
            done = int(place[c])
            before = before[before >= 0]
            before = before[smaller[before]]
            same = s[before] == c
            _append(sa, place, s, before[same], -1)
            scanned.append(before[~same])
        before = sa[start[c] : larger[c]][::-1] - 1
        before = before[before >= 0]
        scanned.append(before[smaller[before]])
        _append(sa, place, s, np.concatenate(scanned), -1)
    # The least symbol stands only at the end and no scan finds it.
    sa[0] = n - 1
    return sa


def _induce_one_by_one(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    n = len(s)
    sizes = np.bincount(s, minlength=k)
    ends = np.cumsum(sizes)
    s = s.astype(np.int64)
    text = s.tolist()
    # The symbol before a suffix if that makes a larger (a smaller) suffix, else -1; -1 also for an empty place (-1).
    larger, smallest = np.full(n + 1, -1), np.full(n + 1, -1)
    larger[1:n] = np.where(smaller[:-1], -1, s[:-1])
    smallest[1:n] = np.where(smaller[:-1], s[:-1], -1)
    sa = [-1] * n
    tail = (ends - 1).tolist()
    for i in lms[::-1].tolist():
        c = text[i]
        sa[tail[c]] = i
        tail[c] -= 1
    place, before = (ends - sizes).tolist(), larger.tolist()
    # A list may grow ahead of the scan that reads it.
    for i in sa:
        c = before[i]
        if c >= 0:
            p = place[c]
            sa[p] = i - 1
            place[c] = p + 1
    place, before = (ends - 1).tolist(), smallest.tolist()
    for i in reversed(sa):
        c = before[i]
        if c >= 0:
            p = place[c]
            sa[p] = i - 1
            place[c] = p - 1
    sa[0] = n - 1
    return np.array(sa, np.int64)


def suffix_array(s: np.ndarray, k: int) -> np.ndarray:
    """Starts of the suffixes of ``s`` in order. Symbols are 0..k-1; the last one is 0 and stands nowhere else.

    Suffixes are classified; an induced sort puts the substrings between leftmost-smaller suffixes in order; equal
    ones get one name, and if names repeat the string of names is sorted in the same way; from the order of the
    leftmost-smaller suffixes all others are induced. Work and memory are linear in the length.
    """
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    smaller = smaller_type(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(lms) > 1:
        if k > BUCKETED:
            names = substring_ranks(s, lms, k)
            ordered = None
        else:
            sa = induce(s, smaller, lms, k)
            is_lms = np.zeros(n, bool)
            is_lms[lms] = True
            ordered = sa[is_lms[sa]]
            ranks = np.empty(n, np.int64)
            ranks[ordered] = _names(s, smaller, lms, ordered)
            names = ranks[lms]
        most = int(names.max()) + 1
        if most < len(lms):
            lms = lms[suffix_array(names, most)]
        elif ordered is None:
            lms = lms[np.argsort(names)]
        else:
            lms = ordered
    return induce(s, smaller, lms, k)


def substring_ranks(s: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """Ranks of the leftmost-smaller substrings, in text order, where there are too many symbols for buckets: symbol by
    symbol, groups of equal beginnings are split until each has one member or has ended.

    Where one ends within another, the other goes on with a larger suffix of the same symbol, which stands before the
    smaller one: the end counts as the greatest symbol.
    """
    length = np.diff(np.r_[lms, len(s) - 1]) + 1
    length[-1] = 1
    # A group's number is how many substrings stand before it.
    group, active, at = np.zeros(len(lms), np.int64), np.arange(len(lms)), 0
    while len(active):
        places = np.minimum(lms[active] + at, len(s) - 1)
        symbol = np.where(at < length[active], s[places], k)
        key = group[active] * (k + 1) + symbol
        order = np.argsort(key, kind="stable")
        active, key, symbol = active[order], key[order], symbol[order]
        first = np.r_[True, key[1:] != key[:-1]]
        starts = np.flatnonzero(first)
        sizes = np.diff(np.r_[starts, len(key)])
        # Within its old group, a new one begins after the members that stand before it.
        old = group[active]
        old_first = np.flatnonzero(np.r_[True, old[1:] != old[:-1]])
        base = np.repeat(old_first, np.diff(np.r_[old_first, len(old)]))
        group[active] = old + np.repeat(starts, sizes) - base
        active = active[(np.repeat(sizes, sizes) > 1) & (symbol < k)]
        at += 1
    distinct, ranks = np.unique(group, return_inverse=True)
    return ranks


def _names(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Ranks of the leftmost-smaller substrings (each up to and with the next one's first symbol) in their order."""
    length = np.zeros(len(s), np.int64)
    length[lms] = np.diff(np.r_[lms, len(s) - 1]) + 1
    length[lms[-1]] = 1
    a, b = ordered[:-1], ordered[1:]
    differ = length[a] != length[b]
    active = np.flatnonzero(~differ)
    at = 0
    while len(active):
        x, y = a[active] + at, b[active] + at
        same = s[x] == s[y]
        differ[active[~same]] = True
        at += 1
        active = active[same & (length[a[active]] > at)]
    return np.r_[0, np.cumsum(differ)]


#: Common prefixes are computed at one of so many neighbours first; the next ones' are shorter by one at most.
STRIDE = 32


def common_prefixes(text: np.ndarray, sa: np.ndarray, width: int) -> np.ndarray:
    """For each suffix, in text order, whether it has ``width`` symbols in common with the one before it in ``sa``."""
    n = len(text)
    raw = np.concatenate([text, np.zeros(width + STRIDE + 16, np.uint8)]).tobytes()
    words = np.ndarray(n + width + STRIDE + 8, "<u8", raw, strides=(1,))
    previous = np.empty(n, np.int64)
    previous[sa[1:]] = sa[:-1]
    previous[sa[0]] = n  # nothing is before the first; zeros follow the text
    long = np.zeros(n, np.int64)
    samples = np.arange(0, n, STRIDE)
    long[samples] = _extend(words, samples, previous[samples], np.zeros(len(samples), np.int64), width + STRIDE, n)
    for j in range(1, STRIDE):
        at = samples + j
        at = at[at < n]
        known = np.maximum(long[at - 1] - 1, 0)
        short = known < width
        mine = at[short]
        long[at] = known
        long[mine] = _extend(words, mine, previous[mine], known[short], width, n)
    return long >= width


def _extend(words: np.ndarray, a: np.ndarray, b: np.ndarray, known: np.ndarray, most: int, n: int) -> np.ndarray:
    """Common prefix lengths of suffixes a and b, given that ``known`` symbols agree, as far as ``most``."""
    out = known.copy()
    active = np.flatnonzero((out < most) & (b < n))
    while len(active):
        x, y = a[active] + out[active], b[active] + out[active]
        inside = np.maximum(x, y) < n
        active, x, y = active[inside], x[inside], y[inside]
        differ = words[x] ^ words[y]
        low = differ & (~differ + np.uint64(1))
        # The lowest set bit of a word tells its first differing byte.
        more = np.where(differ == 0, 8, (np.frexp(low.astype(np.float64))[1] - 1) // 8)
        out[active] += more
        active = active[(more == 8) & (out[active] < most)]
    return out


#: Symbols of a shard: 0 for the end, 1 for the gap between strings, and bytes from 2 on; UTF-8 has no byte above 0xF4.
SHIFT = 2


def repeated_starts(strings: list[bytes], starts: list[int], weights: list[int], width: int) -> list[np.ndarray]:
    """For each string, which of its first ``starts`` places begin ``width`` bytes that begin at more than one of the
    places of all strings; a string stands for ``weights`` equal ones. Each has at least starts + width - 1 bytes."""
    sizes = np.array(list(map(len, strings)))
    # Bytes are shifted by two, so that 0xFF becomes the gap; a zero ends the shard.
    text = np.frombuffer(b"\xff".join([*strings, b""]), np.uint8) + np.uint8(SHIFT)
    text = np.append(text, np.uint8(0))
    first = np.cumsum(sizes + 1) - sizes - 1
    weight = np.zeros(len(text), np.int64)
    many = np.array(starts)
    weight[np.arange(int(many.sum())) + np.repeat(first - (np.cumsum(many) - many), many)] = np.repeat(weights, many)
    sa = suffix_array(text, 256)
    alike = common_prefixes(text, sa, width)[sa]
    run = np.cumsum(~alike)
    total = np.bincount(run, weight[sa])
    repeated = np.empty(len(text), bool)
    repeated[sa] = total[run] >= 2
    return [repeated[a : a + n] for a, n in zip(first.tolist(), starts, strict=True)]
