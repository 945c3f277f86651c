"""Suffix arrays of byte shards by induced sorting, and their permuted common prefixes.

The steps of induced sorting work on whole buckets at a time with numpy: suffixes induced by
one bucket keep their order, so they may be put in place together. Only runs of one byte
induce into their own bucket, once per length.
"""

from __future__ import annotations

import numpy as np

SEPARATOR = 0xFF  # never part of UTF-8
STEP = np.uint64(0x9E3779B97F4A7C15)


def classify(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last is."""
    n = len(text)
    rise = np.zeros(n, np.int8)
    rise[:-1] = np.sign(text[1:].astype(np.int32) - text[:-1])
    rise[-1] = 1
    at = np.where(rise != 0, np.arange(n), n - 1)
    return rise[np.minimum.accumulate(at[::-1])[::-1]] > 0


def _place(out: np.ndarray, found: np.ndarray, chars: np.ndarray, tips: np.ndarray, step: int) -> None:
    """Put suffixes at the tips of their buckets in order; the tips move by ``step``."""
    order = np.argsort(chars, kind="stable")
    sorted_ = chars[order]
    counts = np.bincount(chars, minlength=len(tips))
    begin = np.cumsum(counts) - counts
    within = np.arange(len(order)) - begin[sorted_]
    out[tips[sorted_] + step * within] = found[order]
    tips += step * counts


def induce(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    """The suffix array induced by the given order of leftmost smaller suffixes."""
    n = len(text)
    counts = np.bincount(text, minlength=sigma)
    ends = np.cumsum(counts)
    starts = ends - counts
    out = np.full(n, -1, np.int32)
    seeds = np.bincount(text[lms], minlength=sigma)
    tips = ends - seeds
    _place(out, lms.astype(np.int32), text[lms], tips.copy(), 1)
    heads = starts.copy()

    def induced(block: np.ndarray, want: bool) -> tuple[np.ndarray, np.ndarray]:
        p = block - 1
        p = p[p >= 0]
        p = p[smaller[p] == want]
        return p, text[p]

    for c in np.flatnonzero(counts):
        lo = starts[c]
        while lo < heads[c]:
            hi = heads[c]
            p, chars = induced(out[lo:hi], False)
            lo = hi
            if len(p):
                _place(out, p, chars, heads, 1)
        p, chars = induced(out[ends[c] - seeds[c] : ends[c]], False)
        if len(p):
            _place(out, p, chars, heads, 1)
    tails = ends - 1
    for c in np.flatnonzero(counts)[::-1]:
        hi = ends[c] - 1
        while hi > tails[c]:
            lo = tails[c]
            p, chars = induced(out[lo + 1 : hi + 1][::-1], True)
            hi = lo
            if len(p):
                _place(out, p, chars, tails, -1)
        p, chars = induced(out[starts[c] : heads[c]][::-1], True)
        if len(p):
            _place(out, p, chars, tails, -1)
    out[0] = n - 1  # the sentinel, smallest of all
    return out


def _ranked(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names: the names themselves if they are distinct,
    else ranks of pairs of doubling length until they are."""
    rank, span, n = names.astype(np.int64), 1, len(names)
    while True:
        after = np.zeros(n, np.int64)
        after[: max(n - span, 0)] = rank[span:] + 1
        key = rank * (int(rank.max(initial=0)) + 3) + after
        order = np.argsort(key, kind="stable")
        new = np.r_[0, np.cumsum(np.diff(key[order]) != 0)]
        rank = np.empty(n, np.int64)
        rank[order] = new
        span *= 2
        if new[-1] == n - 1 or span >= 2 * n:
            return order


def suffix_array(raw: np.ndarray) -> np.ndarray:
    """Suffixes of a byte array in order (the empty one is left out)."""
    text = np.append(raw.astype(np.uint16) + 1, 0).astype(np.uint16)
    n, sigma = len(text), 257
    if n == 1:
        return np.empty(0, np.int32)
    smaller = classify(text)
    is_lms = np.r_[False, smaller[1:] & ~smaller[:-1]]
    lms = np.flatnonzero(is_lms)
    by_piece = induce(text, smaller, lms, sigma)
    found = by_piece[is_lms[by_piece]]  # leftmost smaller substrings in order
    # name substrings: equal ones (by length and 64-bit hash) share a name
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        value = sums[1:]
        value[:] = text
        value += np.uint64(1)
        value *= np.uint64(0xD6E8FEB86659FD93)
        value ^= value >> np.uint64(32)
        value *= np.cumprod(np.full(n, STEP))
        np.cumsum(value, out=value)
        stop = np.full(n, n, np.int32)
        stop[lms[:-1]] = lms[1:] + 1
        back = np.cumprod(np.full(n, np.uint64(pow(int(STEP), -1, 1 << 64))))[found]
        digest = (sums[stop[found]] - sums[found]) * back
        del sums, value, back
    length = stop[found] - found
    new = np.r_[True, (digest[1:] != digest[:-1]) | (length[1:] != length[:-1])]
    names = np.empty(n, np.int32)
    names[found] = np.cumsum(new) - 1
    order = lms[_ranked(names[lms])] if not new.all() else found
    return induce(text, smaller, order, sigma)[1:]


def permuted_common_prefixes(raw: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the length it shares with the suffix before its own in order, and that
    suffix (-1: none). Only where the bytes before differ are bytes compared; elsewhere the
    length is one less than at the place before."""
    n = len(raw)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.r_[raw, np.zeros(16, np.uint8)]
    words = np.ndarray((n + 8,), "<u8", padded.tobytes(), 0, (1,))
    at = np.arange(n)
    fresh = np.ones(n, bool)
    both = (before > 0) & (at > 0)
    fresh[both] = raw[at[both] - 1] != raw[before[both] - 1]
    fresh[before < 0] = True
    shared = np.zeros(n, np.int64)
    live = np.flatnonzero(fresh & (before >= 0))
    done = 0
    while len(live):
        i, j = live + done, before[live] + done
        room = n - np.maximum(i, j)
        inside = room > 0
        live, i, j, room = live[inside], i[inside], j[inside], room[inside]
        differ = words[i] ^ words[j]
        low = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) // 8
        same = np.where(differ == 0, 8, low).astype(np.int64)
        shared[live] += np.minimum(same, room)
        live = live[(differ == 0) & (room > 8)]
        done += 8
    last = np.maximum.accumulate(np.where(fresh, at, -1))
    return np.maximum(shared[last] - (at - last), 0), before
