"""Suffix sorting by linear grouping, without recursive renaming.

Phase 1 groups suffixes by their Lyndon prefixes. Groups start as the suffixes
of each first symbol and are processed in descending order. The previous
smaller pointer of a suffix in the group at hand is the nearest suffix to its
left in a lower group; suffixes that are pointed at l times leave their group
for a new one right behind it, ordered by l.

Phase 2 emits each group's order: read from left to right, each suffix of the
array places the suffix before it, and those on that one's chain of pointers,
at the next free place of their groups.
"""

from __future__ import annotations

from collections import Counter, defaultdict


def suffix_array(s: list[int]) -> list[int]:
    """Starts of the suffixes of ``s`` in ascending order. The last symbol
    must be smaller than all others and occur once."""
    n = len(s)
    symbols = sorted(set(s))
    members: list[list[int]] = [[] for _ in symbols]
    number = {c: g for g, c in enumerate(symbols)}
    group = [number[c] for c in s]
    for i, g in enumerate(group):
        members[g].append(i)
    lower = list(range(-1, len(symbols) - 1))
    higher = [*range(1, len(symbols)), -1]

    done = bytearray(n)
    prev = [-1] * n
    order: list[tuple[int, int]] = []  # (group, size), descending
    g = len(symbols) - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        members[g] = []
        for i in own:
            done[i] = 1
        pointed: Counter[int] = Counter()
        for i in own:
            j = i - 1
            while j >= 0 and done[j]:
                j = prev[j]
            prev[i] = j
            if j >= 0:
                pointed[j] += 1
        order.append((g, len(own)))
        times = defaultdict(list)
        for j, count in pointed.items():
            times[count].append(j)
        for count in sorted(times, reverse=True):
            new: dict[int, int] = {}
            for j in times[count]:
                old = group[j]
                h = new.get(old)
                if h is None:
                    h = new[old] = len(members)
                    members.append([])
                    above = higher[old]
                    lower.append(old)
                    higher.append(above)
                    lower[above] = h
                    higher[old] = h
                group[j] = h
                members[h].append(j)
        g = lower[g]

    start = [0] * len(members)
    at = 0
    for g, size in reversed(order):
        start[g] = at
        at += size
    out = [-1] * n
    out[0] = n - 1
    placed = bytearray(n)
    placed[n - 1] = 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[start[g]] = j
            start[g] += 1
            placed[j] = 1
            j = prev[j]
    return out
