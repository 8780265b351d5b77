"""Suffix array in linear time by grouping suffixes with equal Lyndon prefixes.

First, suffixes are grouped by their first symbol and the groups are processed from the highest down.
For each suffix of a group the previous smaller pointer leads to the nearest suffix on its left in a
lower group; that suffix's known prefix is followed by the group's. So the suffixes pointed to move to
new groups just above their own, those with more pointers higher. When all groups are processed, each
holds the suffixes with one Lyndon prefix, in the right order of groups.

Then the order inside the groups follows in one pass from the lowest suffix up: the suffixes whose
Lyndon prefix ends where the current suffix starts are found along the pointers, and each takes the
next free place of its group. Nothing is renamed or sorted recursively.
"""

from __future__ import annotations


def suffix_array(symbols: list[int]) -> list[int]:
    """Starts of the suffixes in order. The last symbol must be smaller than all others."""
    n = len(symbols)
    if n < 2:
        return list(range(n))
    order = sorted(range(n), key=symbols.__getitem__)
    group = [0] * n  # the place where a suffix's group starts
    size = [0] * n
    place = [0] * n
    start, last = 0, None
    for at, i in enumerate(order):
        place[i] = at
        if symbols[i] != last:
            start, last = at, symbols[i]
        group[i] = start
        size[start] += 1
    smaller = list(range(-1, n - 1))
    end = n - 1
    while end >= 0:
        here = group[order[end]]
        pointers: dict[int, int] = {}
        if here == end:
            members = (order[end],)
        else:
            members = sorted(order[here : end + 1])
        for i in members:
            p = i - 1
            while p >= 0 and group[p] > here:
                p = smaller[p]
            if p >= 0:
                if group[p] == here:
                    p = smaller[p]
                    smaller[i] = p
                    if p >= 0:
                        pointers[p] += 1
                else:
                    smaller[i] = p
                    pointers[p] = 1
            else:
                smaller[i] = p
        if pointers:
            classes = {1: pointers}
            if len(members) > len(pointers):
                classes = {}
                for j, times in pointers.items():
                    classes.setdefault(times, []).append(j)
            for times in sorted(classes, reverse=True):
                moved: dict[int, int] = {}
                for j in classes[times]:
                    g = group[j]
                    done = moved.get(g, 0)
                    to, at = g + size[g] - 1 - done, place[j]
                    if to != at:
                        other = order[to]
                        order[to], order[at] = j, other
                        place[j], place[other] = to, at
                    moved[g] = done + 1
                for g, m in moved.items():
                    if m < size[g]:
                        size[g] -= m
                        new = g + size[g]
                        size[new] = m
                        for j in order[new : new + m]:
                            group[j] = new
        end = here - 1
    out = [0] * n
    free = list(range(n))  # next free place, by the start of a group
    out[0] = n - 1
    placed = bytearray(n)
    placed[n - 1] = 1
    for at in range(n):
        i = out[at] - 1
        while i >= 0 and not placed[i]:
            g = group[i]
            out[free[g]] = i
            free[g] += 1
            placed[i] = 1
            i = smaller[i]
    return out
