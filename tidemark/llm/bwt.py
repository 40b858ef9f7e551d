"""Repeated strings of a fixed length, by interval expansion on a Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np

# Bytes compared by the first sort; expansion begins with strings of this length.
FIRST = 8


def sorted_rotations(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, borders): rotations of ``text`` sorted by their first ``length`` bytes.

    ``borders[i]`` says that rotations i - 1 and i differ in their first FIRST bytes. Ties beyond
    ``length`` stay in any order. Each round doubles the compared length and sorts only the
    rotations that are not yet told apart.
    """
    n = len(text)
    at = np.arange(n)
    key = np.zeros(n, np.uint64)
    for i in range(FIRST):
        key = (key << np.uint64(8)) | text[(at + i) % n].astype(np.uint64)
    order = np.argsort(key)
    borders = np.ones(n, bool)
    borders[1:] = key[order][1:] != key[order][:-1]
    heads = borders.copy()
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(heads, at, 0))
    known = FIRST
    while known < length:
        step = min(known, length - known)
        single = heads & np.r_[heads[1:], True]
        rows = np.flatnonzero(~single)
        if not len(rows):
            break
        place = order[rows]
        pair = rank[place] * n + rank[(place + step) % n]
        by_pair = np.argsort(pair)
        place, pair = place[by_pair], pair[by_pair]
        order[rows] = place
        fresh = np.r_[True, pair[1:] != pair[:-1]]
        heads[rows] |= fresh
        rank[place] = rows[np.maximum.accumulate(np.where(fresh, np.arange(len(rows)), 0))]
        known += step
    return order, borders


def lcp_below(order: np.ndarray, text: np.ndarray, borders: np.ndarray, length: int) -> np.ndarray:
    """Marks the neighbours in ``order`` whose common prefix is shorter than ``length``.

    Common prefixes are found in increasing size. An interval holds the rotations that begin with
    one string; putting a byte before the string gives the intervals one longer, which are read
    off the transform (the byte before each rotation). The end of an interval is a border between
    neighbours whose common prefix is that long. Only intervals that reveal a new border are
    expanded further, so every border is found once, and the expansion ends at ``length``.
    """
    n = len(text)
    back = np.empty(n, np.int64)
    back[order] = np.arange(n)
    back = back[(order - 1) % n]
    before = text[(order - 1) % n]
    known = np.r_[borders, True]
    lows = np.flatnonzero(borders)
    highs = np.r_[lows[1:], n]
    for _ in range(FIRST, length):
        if not len(lows):
            break
        sizes = highs - lows
        parent = np.repeat(np.arange(len(lows)), sizes)
        rows = np.arange(len(parent)) + np.repeat(lows - (np.cumsum(sizes) - sizes), sizes)
        image = back[rows]
        by_image = np.argsort(image)
        image, parent, byte = image[by_image], parent[by_image], before[rows][by_image]
        heads = np.flatnonzero(
            np.r_[True, (parent[1:] != parent[:-1]) | (byte[1:] != byte[:-1])]
        )
        lows = image[heads]
        highs = lows + np.diff(np.r_[heads, len(image)])
        new = ~known[highs]
        lows, highs = lows[new], highs[new]
        known[highs] = True
    return known[:n]


def repeated(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of ``starts`` begin a string of ``length`` bytes that another of them begins too.

    Every string must lie inside ``text``; only ``starts`` count as occurrences.
    """
    out = np.zeros(len(starts), bool)
    if len(starts) < 2:
        return out
    wanted = np.full(len(text), -1, np.int64)
    wanted[starts] = np.arange(len(starts))
    order, borders = sorted_rotations(text, length)
    group = np.cumsum(lcp_below(order, text, borders, length)) - 1
    index = wanted[order]
    chosen = index >= 0
    sizes = np.bincount(group[chosen], minlength=group[-1] + 1)
    out[index[chosen]] = sizes[group[chosen]] > 1
    return out
