"""Suffix order by linear grouping construction."""

from __future__ import annotations

from collections.abc import Sequence


def suffix_order(text: Sequence[int]) -> list[int]:
    """The start positions of the suffixes of ``text`` in ascending order.

    ``text`` ends with a value that is smaller than all others.  First every suffix goes to the group of its Lyndon prefix:
    groups begin as single characters and are taken in descending order; the members' previous smaller suffixes are
    looked up by following pointers that are already known, and each such suffix moves to a new group right above its own,
    the higher the more members of the current group follow it.  Then the order is emitted from the smallest suffix
    on: placing a suffix fixes the places of the one before it and of that one's chain of previous smaller suffixes.
    Nothing is renamed and solved again in a smaller problem.
    """
    size = len(text)
    ranks = {c: r for r, c in enumerate(sorted(set(text)))}
    group = [ranks[c] for c in text]
    members: list[list[int]] = [[] for _ in ranks]
    for at, g in enumerate(group):
        members[g].append(at)
    below = list(range(-1, len(ranks) - 1))  # the next lower group
    above = [*range(1, len(ranks)), -1]
    done = [False] * len(ranks)
    previous = [-1] * size

    current, lowest = len(ranks) - 1, 0
    while current >= 0:
        done[current] = True
        followed: dict[int, int] = {}
        for at in sorted(s for s in members[current] if group[s] == current):
            before = at - 1
            while before >= 0 and done[group[before]]:
                before = previous[before]
            previous[at] = before
            if before >= 0:
                followed[before] = followed.get(before, 0) + 1
        moved: dict[tuple[int, int], int] = {}
        for at, times in sorted(followed.items(), key=lambda x: -x[1]) if len(followed) > 1 else followed.items():
            key = (group[at], times)
            new = moved.get(key)
            if new is None:
                new = moved[key] = len(members)
                old = key[0]
                members.append([])
                done.append(False)
                below.append(old)
                above.append(above[old])
                if above[old] >= 0:
                    below[above[old]] = new
                above[old] = new
            group[at] = new
            members[new].append(at)
        current = below[current]

    head, place, current = [0] * len(members), 0, lowest
    while current >= 0:
        head[current] = place
        place += sum(group[s] == current for s in members[current])
        current = above[current]
    order, placed = [-1] * size, [False] * size
    order[0], placed[size - 1] = size - 1, True
    for rank in range(size):
        at = order[rank] - 1
        while at >= 0 and not placed[at]:
            g = group[at]
            order[head[g]] = at
            head[g] += 1
            placed[at] = True
            at = previous[at]
    return order
