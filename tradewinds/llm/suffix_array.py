"""Suffix arrays by grouping suffixes on their Lyndon prefixes, in linear time and without recursive renaming."""

from __future__ import annotations


def suffix_array(text: bytes) -> list[int]:
    """Starts of all suffixes of ``text`` in lexicographic order.

    First suffixes stand in groups by their first byte. Groups are taken in
    descending order; each member points to the nearest suffix before it that
    is in a smaller group, and a suffix that k members point to moves, larger k
    last, out of its group into a new one right behind. At the end a group holds
    the suffixes of one longest Lyndon prefix, and groups stand in order. Then
    suffixes are emitted in ascending order: when one is emitted, the suffix
    before it and those its pointers lead to take the next places of their
    groups, until one that has its place.
    """
    n = len(text)
    if n == 0:
        return []
    buckets: list[list[int]] = [[] for _ in range(256)]
    for i, c in enumerate(text):
        buckets[c].append(i)
    order: list[int] = []
    group = [0] * n  # of each suffix: where its group starts in ``order``
    place = [0] * n
    size = [0] * n
    for members in buckets:
        if members:
            start = len(order)
            size[start] = len(members)
            for i in members:
                group[i] = start
            order += members
    for at, i in enumerate(order):
        place[i] = at
    before = [-1] * n
    end = n
    while end:
        start = group[order[end - 1]]
        members = order[start:end]
        end = start
        if len(members) == 1:
            i = members[0]
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = before[p]
            before[i] = p
            if p < 0:
                continue
            own = group[p]
            if size[own] > 1:
                last = own + size[own] - 1
                size[own] -= 1
                q, at = order[last], place[p]
                order[at], place[q] = q, at
                order[last], place[p] = p, last
                group[p], size[last] = last, 1
            continue
        members.sort()
        pointed: dict[int, int] = {}
        for i in members:
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = before[p]
            before[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        if not pointed:
            continue
        classes: dict[int, list[int]] = {}
        for p, k in pointed.items():
            classes.setdefault(k, []).append(p)
        for k in sorted(classes, reverse=True):
            moved: dict[int, list[int]] = {}
            for p in classes[k]:
                moved.setdefault(group[p], []).append(p)
            for own, leaving in moved.items():
                if len(leaving) == size[own]:
                    continue  # the whole group grows by the same prefix
                last = own + size[own]
                size[own] -= len(leaving)
                for p in leaving:
                    last -= 1
                    q, at = order[last], place[p]
                    order[at], place[q] = q, at
                    order[last], place[p] = p, last
                for p in leaving:
                    group[p] = last
                size[last] = len(leaving)
    # a suffix that ends the text by itself is smaller than any that it begins: it is emitted first among its group
    free = list(range(n))
    done = [False] * n
    out = [0] * n

    def put(j: int) -> None:
        while j >= 0 and not done[j]:
            done[j] = True
            at = free[group[j]]
            free[group[j]] = at + 1
            out[at] = j
            j = before[j]

    put(n - 1)
    for at in range(n):
        put(out[at] - 1)
    return out
