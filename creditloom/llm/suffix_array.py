"""Suffix arrays by grouping, in linear time and without recursion.

Suffixes are put in groups by their Lyndon prefix. Groups are taken from the largest to the smallest: each of their suffixes finds its
previous smaller suffix by pointers already set, and the prefix of that one grows by the group's, which splits its group. Once all
prefixes are whole, suffixes are emitted from the smallest on: every suffix hands the next place of their group to those before it whose
next smaller suffix it is. Plain Python over lists: meant for texts of up to some megabytes inside a task.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of ``text`` in order; its last symbol must be smaller than all others."""
    n = len(text)
    by_symbol = np.argsort(text, kind="stable")
    place = np.empty(n, np.int64)
    place[by_symbol] = np.arange(n)
    first = np.searchsorted(text[by_symbol], text)
    order, place = by_symbol.tolist(), place.tolist()
    group = first.tolist()  # a group is known by its first place
    size = np.bincount(first, minlength=n).tolist()
    smaller = [-1] * n  # previous smaller suffix, known for groups that are done

    def to_end(suffix: int) -> None:
        """Move a suffix to the end of its group and leave it out of the group's size."""
        g = group[suffix]
        size[g] -= 1
        last, at = g + size[g], place[suffix]
        if at != last:
            other = order[last]
            order[at], order[last] = other, suffix
            place[other], place[suffix] = at, last

    end = n - 1
    while end > 0:
        suffix = order[end]
        begin = group[suffix]
        if begin == end:  # alone in its group, as most are: the same steps without the book-keeping
            before = suffix - 1
            while before >= 0 and place[before] >= begin:
                before = smaller[before]
            smaller[suffix] = before
            end -= 1
            if before >= 0:
                g = group[before]
                rest = size[g] - 1
                if rest:
                    size[g] = rest
                    last, at = g + rest, place[before]
                    if at != last:
                        other = order[last]
                        order[at], order[last] = other, before
                        place[other], place[before] = at, last
                    group[before] = last
                    size[last] = 1
            continue
        grown: dict[int, int] = {}  # how many times in a row the group's prefix follows that of a smaller suffix
        for suffix in sorted(order[begin : end + 1]):
            before = suffix - 1
            while before >= 0 and place[before] >= begin:
                before = smaller[before]
            smaller[suffix] = before
            if before >= 0:
                grown[before] = grown.get(before, 0) + 1
        end = begin - 1
        # Those that grow most are largest, so they move behind the rest of their group first.
        for times in sorted(set(grown.values()), reverse=True):
            alike = [suffix for suffix, grows in grown.items() if grows == times]
            for suffix in alike:
                to_end(suffix)
            parts = {g: g + size[g] for g in {group[suffix] for suffix in alike}}
            for suffix in alike:
                group[suffix] = part = parts[group[suffix]]
                size[part] += 1

    out = [-1] * n
    out[0] = order[0]
    emitted = bytearray(n)
    emitted[order[0]] = 1
    free = list(range(n))  # next place of each group
    for at in range(n):
        before = out[at] - 1
        while before >= 0 and not emitted[before]:
            g = group[before]
            to = free[g]
            out[to] = before
            free[g] = to + 1
            emitted[before] = 1
            before = smaller[before]
    return np.array(out, np.int64)
