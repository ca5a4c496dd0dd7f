"""Deep-shallow sorting of byte strings, and what it tells about their common parts."""

from __future__ import annotations

from bisect import bisect_left, insort

SHALLOW, STEP = 64, 8
"""Multikey quicksort goes so many bytes deep, so many at a time; then a blind trie takes over."""


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    return n - ((int.from_bytes(a) ^ int.from_bytes(b)).bit_length() + 7) // 8


def blind_sort(strings: list[bytes], group: list[int]) -> list[int]:
    """Order of strings with a long common prefix: each meets one leaf, and only there is it read whole.

    A node is [depth, {byte at depth or -1 at the end: child}], a leaf a list of equal strings
    marked by depth -1.
    """
    root = [-1, [group[0]]]
    for i in group[1:]:
        text, node = strings[i], root
        while node[0] >= 0:
            at = text[node[0]] if node[0] < len(text) else -1
            node = node[1].get(at) or next(iter(node[1].values()))
        other = strings[node[1][0]]
        depth = common(text, other)
        if depth == len(text) == len(other):
            node[1].append(i)
            continue
        mine = text[depth] if depth < len(text) else -1
        above, node = None, root
        while 0 <= node[0] < depth:
            at = text[node[0]] if node[0] < len(text) else -1
            above, node = (node, at), node[1][at]
        if node[0] == depth:
            node[1][mine] = [-1, [i]]
            continue
        split = [depth, {mine: [-1, [i]], (other[depth] if depth < len(other) else -1): node}]
        if above is None:
            root = split
        else:
            above[0][1][above[1]] = split
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if node[0] < 0:
            order += node[1]
        else:
            stack += [node[1][at] for at in sorted(node[1], reverse=True)]
    return order


def deep_shallow(strings: list[bytes]) -> list[int]:
    """Indices of the strings in ascending order."""
    order: list[int] = []
    stack = [(list(range(len(strings))), 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) < 2:
            order += group
        elif depth >= SHALLOW:
            order += blind_sort(strings, group)
        else:
            pivot = sorted(strings[i][depth : depth + STEP] for i in group[:: max(1, len(group) // 9)])
            pivot = pivot[len(pivot) // 2]
            less, same, more = [], [], []
            for i in group:
                key = strings[i][depth : depth + STEP]
                (less if key < pivot else same if key == pivot else more).append(i)
            stack.append((more, depth))
            # A key cut short by the string's end is the whole rest: equal strings.
            stack.append((same, depth + STEP if len(pivot) == STEP else SHALLOW))
            stack.append((less, depth))
    return order


def furthest(first: list[bytes], second: list[bytes], length: int) -> list[int]:
    """For each i the largest common(first[i], first[j]) over all j with common(first) + common(second) >= length.

    -1 where there is no such j. Neighbours in the order of ``first`` are united from their
    longest common prefix down; within a run the members stand in the order of ``second``,
    where the nearest ones have the longest common prefixes. The smaller run is looked up
    in the larger one, and a member is settled once.
    """
    found = [-1] * len(first)
    order, rank_of = deep_shallow(first), [0] * len(first)
    by_second = deep_shallow(second)
    for rank, i in enumerate(by_second):
        rank_of[i] = rank
    edges = sorted(((common(first[a], first[b]), k) for k, (a, b) in enumerate(zip(order, order[1:], strict=False))), reverse=True)
    parent = list(range(len(order)))
    runs = [([rank_of[i]], [rank_of[i]]) for i in order]

    def top(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for r, k in edges:
        a, b = top(k), top(k + 1)
        if len(runs[a][0]) < len(runs[b][0]):
            a, b = b, a
        (members, still), (few, few_open) = runs[a], runs[b]
        need = length - r
        for rank in list(few_open):
            at, mine = bisect_left(members, rank), second[by_second[rank]]
            near = members[max(0, at - 1) : at + 1]
            if any(common(mine, second[by_second[x]]) >= need for x in near):
                found[by_second[rank]] = r
                few_open.remove(rank)
        for rank in few:
            mine, at = second[by_second[rank]], bisect_left(still, rank)
            while at < len(still) and common(mine, second[by_second[still[at]]]) >= need:
                found[by_second[still.pop(at)]] = r
            while at and common(mine, second[by_second[still[at - 1]]]) >= need:
                at -= 1
                found[by_second[still.pop(at)]] = r
        for rank in few:
            insort(members, rank)
        for rank in few_open:
            insort(still, rank)
        parent[b] = a
        runs[b] = ([], [])
    return found


def reaches(left: list[bytes], right: list[bytes], length: int) -> list[tuple[int, int]]:
    """For places with bytes before (nearest first) and from them on: how far back and forth some
    other place agrees, over partners that agree on ``length`` bytes in all; (0, 0) where none does.
    """
    if len(left) > 8:
        back, forth = furthest(left, right, length), furthest(right, left, length)
        return [(max(a, 0), max(b, 0)) if a >= 0 else (0, 0) for a, b in zip(back, forth, strict=True)]
    out = [(0, 0)] * len(left)
    for i in range(len(left)):
        for j in range(i):
            r = common(right[i], right[j])
            if r + min(len(left[i]), len(left[j])) >= length:
                back = common(left[i], left[j])
                if back + r >= length:
                    out[i] = (max(out[i][0], back), max(out[i][1], r))
                    out[j] = (max(out[j][0], back), max(out[j][1], r))
    return out
