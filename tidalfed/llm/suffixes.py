"""Suffix arrays by linear grouping, for many short strings side by side.

Every suffix belongs to the group of its longest Lyndon prefix. Groups start as first
symbols and are worked off in descending order: each member points to its previous smaller
suffix (the last one before it in a lower group), and a suffix pointed at k times moves into
a new group just above the one it was in, the higher the larger k, since its Lyndon prefix
grows by k copies of the group's. Then the order inside groups is emitted from the left: the
suffix before one that has its place, and the chain of its previous smaller suffixes, take
the next places of their groups. Nothing is renamed and no recursion is needed.

The strings are independent, so one step works on the current group of all of them at once.
"""

from __future__ import annotations

import numpy as np

#: Symbols below the bytes: end of a string, and of a part of it.
END, PART = 0, 1
LOWEST = 2


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def suffix_arrays(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions in suffix order, string after string.

    String k is ``text[starts[k]:ends[k]]``; strings follow one another and each ends with
    ``END``, which occurs nowhere else in it.
    """
    previous, group = lyndon_groups(text, starts, ends)
    return emitted(previous, group, starts, ends)


def lyndon_groups(text: np.ndarray, starts: np.ndarray,
                  ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per position, its previous smaller suffix (-1: none) and its group's first place."""
    n = len(text)
    string = np.repeat(np.arange(len(starts), dtype=np.int64), ends - starts)
    order = np.argsort(string * 512 + text, kind="stable").astype(np.int32)
    key = (string * 512 + text)[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(first, n))
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    group = np.empty(n, np.int32)
    group[order] = np.repeat(first, sizes).astype(np.int32)
    size = np.zeros(n, np.int32)
    size[first] = sizes
    previous = np.full(n, -1, np.int32)
    marked = np.zeros(n, bool)
    begin, top = starts.astype(np.int64), ends.astype(np.int64)
    while len(top):
        low = group[order[top - 1]].astype(np.int64)
        width = top - low
        members = order[spans(low, width)].astype(np.int64)
        floor, level = np.repeat(begin, width), np.repeat(low, width)
        parent = previous_smaller(members, floor, level, previous, group)
        previous[members] = parent
        regroup(parent[parent >= 0].astype(np.int64), order, place, group, size, marked)
        going = low > begin
        begin, top = begin[going], low[going]
    return previous, group


def previous_smaller(members: np.ndarray, floor: np.ndarray, level: np.ndarray,
                     previous: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Last position before each member that lies in a group below its own.

    Positions of higher groups are skipped by their own pointers; members of the same group
    are skipped by the pointers found so far in this step.
    """
    at = members - 1
    at[at < floor] = -1
    previous[members] = at
    active = np.flatnonzero(at >= 0)
    while len(active):
        here = at[active]
        higher = group[here] >= level[active]
        active, here = active[higher], here[higher]
        at[active] = previous[here]
        previous[members[active]] = at[active]
        active = active[at[active] >= 0]
    return at


def regroup(parents: np.ndarray, order: np.ndarray, place: np.ndarray, group: np.ndarray,
            size: np.ndarray, marked: np.ndarray) -> None:
    """Move suffixes pointed at k times to a new group above the rest of theirs, by k."""
    if not len(parents):
        return
    parents = np.sort(parents)
    first = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
    times = np.diff(np.append(first, len(parents)))
    moved = parents[first]
    old = group[moved].astype(np.int64)
    if len(moved) > 1:
        sort = np.lexsort((times, old))
        moved, times, old = moved[sort], times[sort], old[sort]
    new_old = np.concatenate([[True], old[1:] != old[:-1]])
    at = np.flatnonzero(new_old)
    number = np.diff(np.append(at, len(moved)))
    homes = old[at]
    tail = homes + size[homes] - number
    slots = spans(tail, number)
    # Suffixes that sit in the tail and stay in the old group change places with moved ones.
    marked[moved] = True
    sitting = order[slots]
    stay = sitting[~marked[sitting]]
    marked[moved] = False
    from_place = place[moved].astype(np.int64)
    free = from_place[from_place < np.repeat(tail, number)]
    order[free] = stay
    place[stay] = free
    order[slots] = moved
    place[moved] = slots
    starts = np.flatnonzero(new_old | np.concatenate([[True], times[1:] != times[:-1]]))
    lengths = np.diff(np.append(starts, len(moved)))
    size[homes] -= number.astype(np.int32)
    size[slots[starts]] = lengths
    group[moved] = np.repeat(slots[starts], lengths)


def emitted(previous: np.ndarray, group: np.ndarray, starts: np.ndarray,
            ends: np.ndarray) -> np.ndarray:
    """The order of all suffixes, from their groups and previous smaller suffixes."""
    n = len(group)
    out = np.full(n, -1, np.int64)
    taken = np.zeros(n, np.int32)  # places of a group that are filled
    placed = np.zeros(n, bool)
    begin, end, at = starts.astype(np.int64), ends.astype(np.int64), starts.astype(np.int64)
    out[begin] = end - 1  # the end of a string is its least suffix
    placed[end - 1] = True
    taken[begin] += 1
    while len(at):
        here = out[at] - 1
        chain = here[here >= begin]
        while len(chain):
            chain = chain[~placed[chain]]
            home = group[chain]
            out[home + taken[home]] = chain
            taken[home] += 1
            placed[chain] = True
            chain = previous[chain].astype(np.int64)
            chain = chain[chain >= 0]
        at = at + 1
        going = at < end
        if not going.all():
            begin, end, at = begin[going], end[going], at[going]
    return out
