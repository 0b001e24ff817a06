"""Repeated strings of a fixed length by interval expansion on a Burrows-Wheeler transform.

Common prefixes of neighbouring suffixes come out in order of their value: the
interval of all suffixes is extended backward by every symbol, breadth first,
and the first string of length ``l + 1`` whose interval ends at a place tells
that the suffixes around that place share exactly ``l`` symbols.  The
expansion stops at the minimum length; places that are still open then divide
suffixes that share at least so much.
"""

from __future__ import annotations

import numpy as np

FRONTIER = 4096


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols at least, by doubling.  As many symbols as fit 63 bits are the first key."""
    count = len(symbols)
    bits = max(1, int(symbols.max()).bit_length())
    reach = 63 // bits
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(reach, np.int64)])
    keys = np.zeros(count, np.int64)
    for k in range(reach):
        keys = keys << bits | padded[k : k + count]
    while True:
        order = np.argsort(keys)
        ordered = keys[order]
        steps = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if reach >= depth or steps[-1] == count - 1:
            return order
        rank = np.empty(count, np.int64)
        rank[order] = steps + 1
        later = np.zeros(count, np.int64)
        if reach < count:
            later[:-reach] = rank[reach:]
        keys = rank * (count + 2) + later
        reach *= 2


def repeated_strings(symbols: np.ndarray, length: int) -> np.ndarray:
    """For every place in ``symbols`` whether the ``length`` symbols from there occur elsewhere too.

    Symbol 0 ends a text; strings that reach past one are not told apart and
    must be ignored by the caller.
    """
    count = len(symbols)
    used, ranks = np.unique(symbols, return_inverse=True)
    order = suffix_order(ranks, length)
    transform = ranks[order - 1]
    below = np.zeros((count + 1, len(used)), np.int32)
    below[np.arange(1, count + 1), transform] = 1
    np.cumsum(below, axis=0, out=below)
    below += np.concatenate([[0], np.cumsum(below[-1])[:-1]]).astype(np.int32)
    common = np.full(count + 1, -1, np.int32)
    common[0] = common[count] = 0
    low, high = np.array([0]), np.array([count])
    for value in range(length):
        lows, highs = [], []
        skipped = int(value > 0 and used[0] == 0)  # strings hold the end of a text as their last symbol only
        for at in range(0, len(low), FRONTIER):
            a = below[low[at : at + FRONTIER], skipped:].ravel()
            b = below[high[at : at + FRONTIER], skipped:].ravel()
            held = np.flatnonzero(b > a)
            held = held[common[b[held]] < 0]
            lows.append(a[held])
            highs.append(b[held])
        low, high = np.concatenate(lows), np.concatenate(highs)
        if not len(low):
            break
        common[high] = value
    shared = common < 0
    out = np.empty(count, bool)
    out[order] = shared[:-1] | shared[1:]
    return out
