"""Suffix sorting by grouping, without recursion.

First the suffixes are grouped by their Lyndon prefixes.  Groups start as the
suffixes of equal first symbols and are taken from the greatest down: each
member points to the previous suffix of a smaller group, and those pointed to
by equally many members of the group leave their own groups for new ones just
above.  Then the suffixes are put in order from the smallest on: a placed
suffix places the one before it at the front of its group, and after it those
along the previous-smaller pointers.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> list[int]:
    """The starts of all suffixes of an integer sequence, in ascending order of suffixes."""
    n = len(symbols)
    if n == 0:
        return []
    # Place 0 holds the empty suffix at the end, which is smaller than all others.
    by_symbol = np.argsort(symbols, kind="stable")
    order = [n, *by_symbol.tolist()]
    sorted_symbols = np.asarray(symbols)[by_symbol]
    first = np.concatenate([[True], sorted_symbols[1:] != sorted_symbols[:-1]])
    starts = np.flatnonzero(first)
    start_of = np.zeros(n + 1, np.int64)
    start_of[by_symbol] = np.repeat(starts, np.diff(np.append(starts, n))) + 1
    group = start_of.tolist()
    place = np.empty(n + 1, np.int64)
    place[np.array(order)] = np.arange(n + 1)
    place = place.tolist()
    size = [0] * (n + 2)
    size[0] = 1
    for s, e in zip((starts + 1).tolist(), (np.append(starts[1:], n) + 1).tolist(), strict=True):
        size[s] = e - s
    before = _group(order, group, place, size, n)
    return _emit(order, group, before, n)


def _group(order: list[int], group: list[int], place: list[int], size: list[int], n: int) -> list[int]:
    """Group by Lyndon prefixes, in place; returns each suffix's previous-smaller pointer."""
    before = [-1] * (n + 1)
    end = n
    while end > 0:
        at = group[order[end]]
        if at == end:
            i = order[end]
            j = i - 1
            while j >= 0 and group[j] >= at:
                j = before[j]
            before[i] = j
            end -= 1
            if j < 0:
                continue
            own = group[j]
            left = size[own] - 1
            if left:
                size[own] = left
                last = own + left
                other, where = order[last], place[j]
                order[where], place[other] = other, where
                order[last], place[j] = j, last
                group[j] = last
                size[last] = 1
            continue
        members = order[at : end + 1]
        members.sort()
        end = at - 1
        count: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= at:
                j = before[j]
            before[i] = j
            if j >= 0:
                count[j] = count.get(j, 0) + 1
        moves: dict[tuple[int, int], list[int]] = {}
        for j, times in count.items():
            moves.setdefault((-times, group[j]), []).append(j)
        for (_, own), some in sorted(moves.items()) if len(moves) > 1 else moves.items():
            left = size[own] - len(some)
            if not left:
                continue
            size[own] = left
            last = own + left
            size[last] = len(some)
            for k, j in enumerate(some, last):
                other, where = order[k], place[j]
                order[where], place[other] = other, where
                order[k], place[j] = j, k
            for j in some:
                group[j] = last
    return before


def _emit(order: list[int], group: list[int], before: list[int], n: int) -> list[int]:
    """Fill the suffix array from the front of the groups."""
    out = [-1] * (n + 1)
    out[0] = n
    front = list(range(n + 2))
    placed = bytearray(n + 1)
    for i in range(n + 1):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            placed[j] = 1
            g = group[j]
            k = front[g]
            out[k] = j
            front[g] = k + 1
            j = before[j]
    return out[1:]
