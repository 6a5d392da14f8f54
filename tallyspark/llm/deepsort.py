"""Deep-shallow sorting of suffixes, for whole arrays at a time.

Shallow: multikey quicksort, eight bytes as one key. A group of suffixes that share all bytes so far is cut by its next key; groups
whose members all have the same key pass on unsorted. Deep: what is still tied at the shallow depth shares a long prefix and is ordered
by blind tries. A trie is built path by path: the first suffix of a group is a path; every other one is compared with it once, and is
known by where it branches off and the byte it branches with. Suffixes with the same branch hang below it as a group of their own, in
the next round; those on the same side in the order of their branches are sorted against the path at once.
"""

from __future__ import annotations

import numpy as np

WORD = 8
SHALLOW = 24
ROWS_AT_ONCE = 1 << 15


def _words(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as one number in byte order. `data` ends with at least eight bytes more than any suffix."""
    view = np.ndarray((len(data) - WORD + 1,), dtype=">u8", buffer=data, strides=(1,))
    return view[at].astype(np.uint64)


def _starts(group: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.empty(0, np.int64)


def _uneven(starts: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Groups with a member that differs from the first one."""
    return ~np.logical_and.reduceat(same, starts) if len(starts) else np.empty(0, bool)


def _refine(order, group, at_rows, keys, per_group):
    """Sorts the rows `at_rows` (whole groups, in order) by `keys` within their group and gives equal keys a group of their own."""
    rank = np.lexsort((keys, per_group))
    order[at_rows] = order[at_rows][rank]
    keys = keys[rank]
    new = np.r_[True, (keys[1:] != keys[:-1]) | (per_group[1:] != per_group[:-1])]
    return rank, new


def deep_shallow_sort(data: np.ndarray, at: np.ndarray, depth: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): the suffixes that begin at `at`, sorted by their first `depth` bytes; equal ones share a group number.

    Every suffix must have `depth` bytes; `data` needs WORD bytes more than that at its end.
    """
    n = len(at)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    shallow = min(shallow, depth) // WORD * WORD
    first = _words(data, at) if shallow else np.zeros(n, np.uint64)
    order = np.argsort(first)
    first = first[order]
    new = np.r_[True, first[1:] != first[:-1]]
    for d in range(WORD, shallow, WORD):
        new = _cut(order, new, lambda rows: _words(data, at[rows] + d))
    new = _tries(data, at, order, new, shallow, depth)
    return order, np.cumsum(new) - 1


def _cut(order: np.ndarray, new: np.ndarray, key_of) -> np.ndarray:
    """One step of the quicksort: the groups that `new` begins are cut by the keys of their members."""
    single = new & np.r_[new[1:], True]
    rows = np.flatnonzero(~single)
    if not len(rows):
        return new
    group = np.cumsum(new)[rows]
    keys = key_of(order[rows])
    starts = _starts(group)
    size = np.diff(np.r_[starts, len(rows)])
    uneven = np.repeat(_uneven(starts, keys == np.repeat(keys[starts], size)), size)
    rows, keys, group = rows[uneven], keys[uneven], group[uneven]
    if len(rows):
        _, begins = _refine(order, None, rows, keys, group)
        new = new.copy()
        new[rows] = begins
    return new


def _branches(data, path, rows, begin, depth):
    """For every suffix against its path: a number that orders it within the group; equal numbers share a branch (or the path's leaf)."""
    width = depth - begin
    out = np.empty(len(rows), np.int64)
    span = np.arange(begin, depth)
    for i in range(0, len(rows), ROWS_AT_ONCE):
        a = data[rows[i:i + ROWS_AT_ONCE, None] + span]
        b = data[path[i:i + ROWS_AT_ONCE, None] + span]
        differ = a != b
        place = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        line, inner = np.arange(len(a)), np.minimum(place, width - 1)
        byte, other = a[line, inner].astype(np.int64), b[line, inner].astype(np.int64)
        # smaller ones that branch early come first, then the path's leaf, then larger ones that branch late
        out[i:i + ROWS_AT_ONCE] = np.where(place == width, width * 256, np.where(byte < other, place * 256 + byte, (2 * width + 1 - place) * 256 + byte))
    return out


def _tries(data, at, order, new, begin, depth):
    """Orders the groups that are tied after `begin` bytes; returns where the groups of equal suffixes begin."""
    if begin >= depth:
        return new
    new = new.copy()
    live = np.flatnonzero(~(new & np.r_[new[1:], True]))
    group = np.cumsum(new)[live]
    while len(live):
        starts = _starts(group)
        size = np.diff(np.r_[starts, len(live)])
        where = at[order[live]]
        branch = _branches(data, np.repeat(where[starts], size), where, begin, depth)
        leaf = (depth - begin) * 256
        uneven = np.repeat(_uneven(starts, branch == leaf), size)
        live, group, branch = live[uneven], group[uneven], branch[uneven]
        if not len(live):
            break
        rank, begins = _refine(order, None, live, branch, group)
        branch = branch[rank]
        new[live] = begins
        next_group = np.cumsum(begins)
        many = np.repeat(np.diff(np.r_[np.flatnonzero(begins), len(live)]) > 1, np.diff(np.r_[np.flatnonzero(begins), len(live)]))
        on = many & (branch != leaf)
        live, group = live[on], next_group[on]
    return new
