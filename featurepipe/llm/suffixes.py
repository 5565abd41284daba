"""Suffix sorting of many short sequences at once, by prefix doubling over the unsorted rest."""

from __future__ import annotations

import numpy as np


def suffix_ranks(keys: np.ndarray, levels: list[np.ndarray] | None = None) -> np.ndarray:
    """Rank of every suffix of ``keys`` (non-negative; 0 is a separator and the last key).

    Separators are all different and ordered by place, so no order or repeat crosses one. The
    rank of a suffix is the number of smaller ones. With ``levels``, the ranks by the first
    1, 2, 4, ... keys are appended to it: equal numbers there mean equal beginnings.
    Each round sorts only those suffixes that still tie.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    start = np.ones(n, bool)
    start[1:] = (sorted_keys[1:] != sorted_keys[:-1]) | (sorted_keys[1:] == 0)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    tied = ~start
    tied[:-1] |= ~start[1:]
    todo = order[tied]                                   # ties stand together, in rank order
    width = 1
    if levels is not None:
        levels.append(rank.astype(np.int32))
    while len(todo):
        group, after = rank[todo], rank[todo + width]
        by = np.lexsort((after, group))
        todo, group, after = todo[by], group[by], after[by]
        m = len(todo)
        new_group, new = np.ones(m, bool), np.ones(m, bool)
        new_group[1:] = group[1:] != group[:-1]
        new[1:] = new_group[1:] | (after[1:] != after[:-1])
        at = np.arange(m)
        begin = np.maximum.accumulate(np.where(new_group, at, 0))
        rank[todo] = group + np.maximum.accumulate(np.where(new, at, 0)) - begin
        tied = ~new
        tied[:-1] |= ~new[1:]
        todo = todo[tied]
        width *= 2
        if levels is not None:
            levels.append(rank.astype(np.int32))
    return rank
