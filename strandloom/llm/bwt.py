"""Repeats of a least length in a set of byte strings, by threshold-bounded interval expansion on a Burrows-Wheeler transform.

The transform of all strings, each closed by a sentinel of its own, is searched breadth first: level l holds the
intervals of strings of length l; extending them backwards by each symbol gives intervals of length l + 1 and so, in
increasing order, the boundaries whose common prefix is l. The search stops at the least length: boundaries that no
level has reached lie between suffixes that share at least that many bytes.
"""

from __future__ import annotations

import numpy as np


def _sorted(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A stable order of keys of so many bits, and where a new key begins in it; the place is sorted along where it fits."""
    n = len(keys)
    width = n.bit_length()
    if bits + width <= 63:
        packed = np.sort(keys << width | np.arange(n))
        order, found = packed & ((1 << width) - 1), packed >> width
    else:
        order = np.argsort(keys, kind="stable")
        found = keys[order]
    return order, np.append(True, found[1:] != found[:-1])


def suffix_order(text: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and its inverse, right to `depth` symbols. text: bytes + 1, with 0 at the sentinels, whose places are `ends`."""
    n = len(text)
    width = n.bit_length()
    gap = np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(n)  # distance to the own sentinel
    used = np.zeros(257, np.int64)
    used[text] = 1
    symbols, bits = (np.cumsum(used) - used[0])[text], max(int(used.sum()).bit_length(), 1)
    symbols[ends] = 0
    h, key = max((63 - width) // bits, 1), np.zeros(n, np.int64)
    for j in range(h):
        shifted = np.zeros(n, np.int64)
        shifted[: max(n - j, 0)] = symbols[j:]
        if j:
            shifted[gap < j] = 0
        key = key << bits | shifted
    order, new = _sorted(key, h * bits)
    new |= gap[order] < h  # sentinels differ, in the order of the strings
    rank = np.empty(n, np.int64)  # the first place of the suffixes that are alike so far
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    at = np.flatnonzero(~(new & np.append(new[1:], True)))
    while h < depth and len(at):  # only those that are alike are sorted on
        alike = order[at]
        by, new = _sorted(rank[alike] << width | rank[alike + h], 2 * width)
        alike = alike[by]
        order[at] = alike
        rank[alike] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        at = at[~(new & np.append(new[1:], True))]
        h *= 2
    inverse = np.empty(n, np.int64)
    inverse[order] = np.arange(n)
    return order, inverse


def repeated_starts(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string the starts of its substrings of `length` bytes that also start anywhere else in the set."""
    if not strings:
        return []
    sizes = np.array([len(s) + 1 for s in strings])
    ends = np.cumsum(sizes) - 1
    text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int64) + 1
    text[ends] = 0
    n = len(text)
    order, inverse = suffix_order(text, ends, length)
    symbol, step = text[order - 1], inverse[order - 1]  # the transform, and where it leads; row of the whole text wraps to a sentinel
    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    # Level 0: the empty string's interval is all rows; sentinels differ from each other, bytes are grouped.
    known[: len(ends) + 1] = True
    low = np.flatnonzero((np.diff(text[order], prepend=-1) != 0) & (np.arange(n) >= len(ends)))
    high = np.append(low[1:], n) - 1 if len(low) else low
    low = np.concatenate([np.arange(len(ends)), low])
    high = np.concatenate([np.arange(len(ends)), high])
    known[high + 1] = True
    for _ in range(1, length):
        if not len(low):
            break
        counts = high - low + 1
        which = np.repeat(np.arange(len(low)), counts)
        rows = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + low[which]
        kept = symbol[rows] > 0
        group, to = which[kept] * 257 + symbol[rows[kept]], step[rows[kept]]
        if not len(group):
            break
        by, new = _sorted(group, (len(low) * 257).bit_length())
        to, first = to[by], np.flatnonzero(new)
        low, high = np.minimum.reduceat(to, first), np.maximum.reduceat(to, first)
        fresh = ~known[high + 1]
        low, high = low[fresh], high[fresh]
        known[high + 1] = True
    deep = np.flatnonzero(~known)
    starts = np.unique(np.concatenate([order[deep], order[deep - 1]]))
    at = np.searchsorted(ends, starts)
    return [x - (ends[i] - sizes[i] + 1) for i, x in enumerate(np.split(starts, np.searchsorted(at, np.arange(1, len(strings)))))]
