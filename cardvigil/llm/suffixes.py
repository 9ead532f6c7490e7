"""Suffix arrays of token sequences."""

from __future__ import annotations

import numpy as np


def suffix_array(tokens: np.ndarray, depth: int) -> np.ndarray:
    """All positions, sorted by the next ``depth`` tokens at least, by doubling.

    A round sorts only positions that are still tied, by the ranks of their group and
    of the position half the depth further on.
    """
    n = len(tokens)
    order = np.argsort(tokens)
    ordered = tokens[order]
    head = np.ones(n, dtype=bool)
    head[1:] = ordered[1:] != ordered[:-1]
    slots = np.arange(n)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, slots, 0))
    step = 1
    while step < depth:
        alone = head.copy()
        alone[:-1] &= head[1:]
        tied = np.flatnonzero(~alone)
        if not len(tied):
            break
        at = order[tied]
        ahead = at + step
        key = rank[at] * (n + 1)
        key[ahead < n] += rank[ahead[ahead < n]] + 1
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[tied] = at
        first = np.ones(len(tied), dtype=bool)
        first[1:] = key[1:] != key[:-1]
        head[tied] = first
        rank[at] = np.maximum.accumulate(np.where(first, tied, 0))
        step *= 2
    return order
