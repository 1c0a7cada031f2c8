"""Suffix arrays by induced sorting, and permuted longest common prefixes (numpy).

The text is a byte array with an implied end smaller than every byte.
Suffixes are classed as smaller (S) or larger (L) than their right neighbour;
leftmost-S positions (an S after an L) are the sorting basis: their substrings
are sorted by one induction, named, and the string of names is sorted in turn
unless all names differ.  From the sorted leftmost-S suffixes two linear scans
induce all others, L suffixes bucket by bucket upwards, S suffixes downwards.
Each scan step takes a whole run of a bucket at once.

The string of names has too large an alphabet for bucket scans that are worth
a vector operation; its suffixes are sorted by recursive doubling instead:
each round names pairs of names, until all differ.
"""

from __future__ import annotations

import numpy as np


def classify(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is S type, leftmost-S positions) of a byte array."""
    n = len(x)
    rise = np.zeros(n, np.int8)
    rise[:-1] = np.sign(x[1:].astype(np.int16) - x[:-1].astype(np.int16))
    rise[-1] = -1  # the end is smaller than any byte
    at = np.where(rise != 0, np.arange(n, dtype=np.int32), np.int32(n - 1))
    nxt = np.minimum.accumulate(at[::-1])[::-1]
    small = rise[nxt] > 0
    left = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    return small, left.astype(np.int32)


def _place(sa, pos, chars, edge, step):
    """Put suffixes into their buckets in order; ``edge`` holds each bucket's next free slot."""
    order = np.argsort(chars, kind="stable")
    c = chars[order]
    count = np.bincount(chars, minlength=256)
    start = np.concatenate([[0], np.cumsum(count)[:-1]])
    rank = np.arange(len(c)) - start[c]
    sa[edge[c] + step * rank] = pos[order]
    edge += step * count


def induce(x: np.ndarray, small: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Suffix array induced from leftmost-S suffixes, given in the wanted order per bucket."""
    n = len(x)
    size = np.bincount(x, minlength=256)
    head = np.concatenate([[0], np.cumsum(size)[:-1]])
    tail = head + size
    sa = np.full(n, -1, np.int32)
    by_char = np.argsort(x[basis], kind="stable")
    basis_sorted = basis[by_char]
    basis_size = np.bincount(x[basis], minlength=256)
    basis_end = np.cumsum(basis_size)
    used = np.flatnonzero(size)

    free = head.copy()  # L types upwards
    sa[free[x[n - 1]]] = n - 1
    free[x[n - 1]] += 1
    for c in used:
        lo = head[c]
        while lo < free[c]:
            hi = free[c]
            prev = sa[lo:hi] - 1
            prev = prev[prev >= 0]
            prev = prev[~small[prev]]
            if len(prev):
                _place(sa, prev, x[prev], free, 1)
            lo = hi
        prev = basis_sorted[basis_end[c] - basis_size[c]:basis_end[c]] - 1
        if len(prev):
            _place(sa, prev, x[prev], free, 1)

    free_s = tail - 1  # S types downwards
    for c in used[::-1]:
        hi = tail[c] - 1
        while hi > free_s[c]:
            lo = free_s[c]
            prev = sa[lo + 1:hi + 1][::-1] - 1
            prev = prev[prev >= 0]
            prev = prev[small[prev]]
            if len(prev):
                _place(sa, prev, x[prev], free_s, -1)
            hi = lo
        prev = sa[head[c]:free[c]][::-1] - 1
        prev = prev[prev >= 0]
        prev = prev[small[prev]]
        if len(prev):
            _place(sa, prev, x[prev], free_s, -1)
    return sa


def _names(x: np.ndarray, left: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
    """Name of each leftmost-S substring by position rank; equal substrings share one. ``order``: sorted positions."""
    rank = np.full(len(x) + 1, -1, np.int32)
    rank[left] = np.arange(len(left), dtype=np.int32)
    ends = np.concatenate([left[1:], [len(x)]]).astype(np.int64)  # the last runs into the end and is unique
    r = rank[order]
    length = ends[r] - order + 1
    a, b = order[:-1].astype(np.int64), order[1:].astype(np.int64)
    last = len(left) - 1
    same = (length[:-1] == length[1:]) & (r[:-1] != last) & (r[1:] != last)
    todo, k = np.flatnonzero(same), 0
    while len(todo):
        equal = x[a[todo] + k] == x[b[todo] + k]
        same[todo[~equal]] = False
        todo = todo[equal]
        k += 1
        todo = todo[k < length[todo]]
    name = np.concatenate([[0], np.cumsum(~same)]).astype(np.int64)
    out = np.empty(len(left), np.int64)
    out[r] = name
    return out, int(name[-1]) + 1


def sort_names(names: np.ndarray) -> np.ndarray:
    """Suffix order of a string of names: recursive doubling, only unsettled suffixes are sorted again."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    v = names[order]
    new = np.concatenate([[True], v[1:] != v[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]  # a group's first place
    k = 1
    while True:
        group = rank[order]
        alone = np.concatenate([[True], group[1:] != group[:-1]])
        alone = alone & np.concatenate([alone[1:], [True]])
        places = np.flatnonzero(~alone)
        if not len(places):
            return order
        pos = order[places]
        nxt = np.full(len(pos), -1, np.int64)
        inside = pos + k < n
        nxt[inside] = rank[pos[inside] + k]
        o = np.lexsort((nxt, rank[pos]))
        pos, nxt, g = pos[o], nxt[o], rank[pos][o]
        order[places] = pos
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (nxt[1:] != nxt[:-1])])
        rank[pos] = places[np.flatnonzero(new)[np.cumsum(new) - 1]]
        k *= 2


def suffix_array(x: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes of a byte array, in ascending order of the suffixes."""
    n = len(x)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    small, left = classify(x)
    if not len(left):
        return induce(x, small, left)
    rough = induce(x, small, left)
    is_left = np.zeros(n, bool)
    is_left[left] = True
    order = rough[is_left[rough]]
    names, count = _names(x, left, order)
    if count < len(left):
        order = left[sort_names(names)]
    return induce(x, small, order)


def permuted_lcp(x: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For every position, the common prefix with the suffix before it in the suffix array.

    A value is irreducible where the two suffixes follow different bytes; only
    those are compared (eight bytes at a time).  Any other is its left
    neighbour's less one.
    """
    n = len(x)
    if not n:
        return np.zeros(0, np.int32)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    i = np.arange(n)
    whole = (before > 0) & (i > 0)
    reducible = np.zeros(n, bool)
    reducible[whole] = x[i[whole] - 1] == x[before[whole] - 1]
    start = np.flatnonzero(~reducible & (before >= 0))
    padded = np.concatenate([x, np.zeros(16, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    value = np.zeros(n, np.int64)
    todo, done = start, np.zeros(len(start), np.int64)
    left = np.arange(len(start))
    room = n - np.maximum(start, before[start])
    while len(left):
        p, q = todo[left] + done[left], before[todo[left]] + done[left]
        same = words[p] == words[q]
        full = same.all(1)
        step = np.where(full, 8, np.argmin(same, 1))
        done[left] = np.minimum(done[left] + step, room[left])
        left = left[full & (done[left] < room[left])]
    value[start] = done
    anchor = np.where(reducible, 0, i)
    anchor = np.maximum.accumulate(anchor)
    return np.maximum(value[anchor] - (i - anchor), 0).astype(np.int32)
