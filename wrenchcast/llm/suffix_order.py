"""Suffix sorting by linear grouping.

Suffixes are grouped by their Lyndon prefix. Groups start as the characters; they are taken in descending order, and each
member finds its previous smaller suffix, the nearest one to its left in a lower group, by following such pointers. A
suffix that members of the group point to continues its own prefix with the group's, as many times as there are
pointers, so it moves behind the rest of its group. When the lowest group is done, all groups are in their final place,
and one pass over the order being written puts each suffix to the next free place of its group, along the same pointers.
Nothing is renamed and there is no recursion.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_order(text: Sequence[int]) -> list[int]:
    """Start positions of the suffixes of ``text`` in rising order; the end sorts before every character."""
    n = len(text) + 1
    counts: dict[int, int] = {}
    for c in text:
        counts[c] = counts.get(c, 0) + 1
    first, at = {}, 1  # place 0 belongs to the empty suffix, a group of its own
    before_end = [0] * (n + 1)  # start of the group that ends before a place
    members: dict[int, list[int]] = {}
    size: dict[int, int] = {}
    before_end[1] = 0
    for c in sorted(counts):
        first[c] = at
        members[at] = []
        size[at] = counts[c]
        at += counts[c]
        before_end[at] = first[c]
    group = [first[c] for c in text]
    group.append(0)
    for i in range(n - 1):
        members[group[i]].append(i)
    prev = [-1] * n
    end = n
    while end > 1:
        g = before_end[end]
        pointed: dict[int, int] = {}
        for i in members.pop(g):
            if group[i] != g:
                continue  # moved on earlier
            s = i - 1
            while s >= 0 and group[s] >= g:
                s = prev[s]
            prev[i] = s
            if s >= 0:
                pointed[s] = pointed.get(s, 0) + 1
        if pointed:
            by_count: dict[int, dict[int, list[int]]] = {}
            for s, k in pointed.items():
                by_count.setdefault(k, {}).setdefault(group[s], []).append(s)
            for k in sorted(by_count, reverse=True):
                for old, moved in by_count[k].items():
                    left = size[old] - len(moved)
                    if left == 0:
                        continue  # the whole rest of its group: it stays in place
                    new = old + left
                    before_end[old + size[old]] = new
                    before_end[new] = old
                    size[old], size[new] = left, len(moved)
                    members[new] = moved
                    for s in moved:
                        group[s] = new
        end = g
    order = [0] * n
    order[0] = n - 1
    free = {}
    placed = bytearray(n)
    placed[n - 1] = 1
    for i in range(n):
        j = order[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            place = free.get(g, g)
            free[g] = place + 1
            order[place] = j
            placed[j] = 1
            j = prev[j]
    return order[1:]
