"""Suffix array by linear grouping.

Phase one starts from groups of suffixes with the same first symbol and visits groups from the greatest down.  Each
suffix of the visited group points to the nearest suffix before it that lies in a smaller group; suffixes that are
pointed at leave their groups for new ones right behind, those with more pointers from this group behind those with
fewer.  In the end a group holds the suffixes with one Lyndon prefix.  Phase two emits the order from the least suffix
on: the suffix before an emitted one, and along the pointers the ones before that, take the first free places of their
groups.  Nothing is renamed or solved recursively.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols) -> list[int]:
    """Order of all suffixes of a non-empty sequence of integers; a shorter suffix comes before its extensions."""
    text = np.asarray(symbols)
    n = len(text) + 1  # the empty suffix is the sentinel
    keys = np.concatenate([np.unique(text, return_inverse=True)[1].ravel() + 1, [0]])
    order = np.argsort(keys, kind="stable").tolist()
    counts = np.bincount(keys)
    ends = np.cumsum(counts).tolist()
    # per group: first place, one past the last; per suffix: its group and its place
    first, last = [0, *ends[:-1]], ends
    group = keys.tolist()
    place = [0] * n
    for k, s in enumerate(order):
        place[s] = k
    prev = [-1] * n

    top = n
    while top > 1:
        s = order[top - 1]
        lo = first[group[s]]
        if lo == top - 1:
            # a group of one: at most one pointer, and a group of one that is pointed at stays as it is
            top = lo
            j = s - 1
            while j >= 0 and first[group[j]] >= lo:
                j = prev[j]
            prev[s] = j
            if j >= 0:
                old = group[j]
                back = last[old] - 1
                if first[old] != back:
                    at, other = place[j], order[back]
                    order[at], place[other] = other, at
                    order[back], place[j] = j, back
                    last[old] = back
                    group[j] = len(first)
                    first.append(back)
                    last.append(back + 1)
            continue
        members = sorted(order[lo:top])
        top = lo
        pointed: dict[int, int] = {}
        for s in members:
            j = s - 1
            while j >= 0 and first[group[j]] >= lo:
                j = prev[j]
            prev[s] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        if not pointed:
            continue
        if len(pointed) == 1:
            sets = [list(pointed)]
        else:
            by_count: dict[int, list[int]] = {}
            for j, c in pointed.items():
                by_count.setdefault(c, []).append(j)
            sets = [by_count[c] for c in sorted(by_count, reverse=True)]
        for chosen in sets:
            new_of: dict[int, int] = {}
            for j in chosen:
                old = group[j]
                new = new_of.get(old)
                if new is None and first[old] == last[old] - 1:
                    continue
                if new is None:
                    new = new_of[old] = len(first)
                    first.append(last[old])
                    last.append(last[old])
                # swap j to the back of its group and let the new group begin there
                back = last[old] - 1
                at, other = place[j], order[back]
                order[at], place[other] = other, at
                order[back], place[j] = j, back
                last[old] = back
                first[new] = back
                group[j] = new

    out = [-1] * n
    out[0] = n - 1
    done = bytearray(n)
    done[n - 1] = 1
    for k in range(n):
        s = out[k] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            out[first[g]] = s
            first[g] += 1
            done[s] = 1
            s = prev[s]
    return out[1:]
