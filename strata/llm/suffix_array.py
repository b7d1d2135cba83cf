"""Suffix array by linear grouping, without recursion or renaming.

Two phases. The first sorts all suffixes into groups: suffixes of a group
share their longest Lyndon prefix. Groups are taken from the greatest down.
Each suffix of the group points to its previous smaller suffix: the closest
one to its left in a smaller group. A suffix that receives pointers has its
known prefix lengthened by the group's, once a pointer, so it moves just
behind its old group, those with more pointers further behind.

The second phase emits the order group by group: the suffix left of each
emitted one, and then the previous smaller suffixes from there, are each next
in their own group.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes of ``text`` in ascending order.

    The last symbol must be smaller than all others. Takes linear time but for
    the chains of equal neighbours that pointers skip.
    """
    n = len(text)
    if n == 0:
        return []
    order = sorted(range(n), key=text.__getitem__)
    place = [0] * n  # of a suffix in order
    start = [0] * n  # of a suffix's group in order
    size = [0] * n  # of the group that starts here
    begin = 0
    for k, i in enumerate(order):
        if text[i] != text[order[begin]]:
            begin = k
        place[i] = k
        start[i] = begin
        size[begin] += 1

    previous = [-1] * n
    end = n
    while end > 0:
        begin = start[order[end - 1]]
        if end - begin == 1:
            i = order[begin]
            j = i - 1
            # The last symbol's group starts at 0, so index -1 ends the search.
            while start[j] > begin and j >= 0:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                group = start[j]
                held = size[group]
                if held > 1:
                    last = group + held - 1
                    other = order[last]
                    at = place[j]
                    order[at] = other
                    place[other] = at
                    order[last] = j
                    place[j] = last
                    size[group] = held - 1
                    size[last] = 1
                    start[j] = last
            end = begin
            continue
        members = sorted(order[begin:end])
        received: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and start[j] >= begin:
                j = previous[j]  # members left of i have theirs already
            previous[i] = j
            if j >= 0:
                received[j] = received.get(j, 0) + 1
        by_count: dict[int, list[int]] = {}
        for j, count in received.items():
            by_count.setdefault(count, []).append(j)
        for count in sorted(by_count, reverse=True):
            by_group: dict[int, list[int]] = {}
            for j in by_count[count]:
                by_group.setdefault(start[j], []).append(j)
            for group, moved in by_group.items():
                left = size[group] - len(moved)
                if not left:
                    continue
                low = last = group + size[group]
                for j in moved:
                    low -= 1
                    other = order[low]
                    at = place[j]
                    order[at] = other
                    place[other] = at
                    order[low] = j
                    place[j] = low
                size[group] = left
                size[low] = last - low
                for j in moved:
                    start[j] = low
        end = begin

    out = [-1] * n
    out[0] = n - 1
    done = [False] * n
    done[n - 1] = True
    free = list(range(n))  # next free place of the group that starts here
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not done[j]:
            group = start[j]
            at = free[group]
            out[at] = j
            free[group] = at + 1
            done[j] = True
            j = previous[j]
    return out
