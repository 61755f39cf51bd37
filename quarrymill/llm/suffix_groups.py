"""Suffix arrays of many short texts at once, by linear grouping: no sorting of suffixes, no recursion, no renaming.

The suffixes of a text are grouped by the longest Lyndon word they begin with, then each group's order is emitted. All
texts of a call advance in lockstep, one group of each at a time, so that a step is a few array operations.
"""

from __future__ import annotations

import numpy as np

_NONE = -1


def _first_groups(text: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups by first letter. A group is named by the number of suffixes in smaller ones.

    Returns the group of each suffix, the size of each group, and the group that ends before each place.
    """
    rows, width = text.shape
    order = np.argsort(text, axis=1, kind="stable")
    letters = np.take_along_axis(text, order, 1)
    place = np.arange(width, dtype=np.int32)
    opens = np.ones(text.shape, bool)
    opens[:, 1:] = letters[:, 1:] != letters[:, :-1]
    start = np.maximum.accumulate(np.where(opens, place, 0), axis=1).astype(np.int32)
    group = np.empty(text.shape, np.int16)
    np.put_along_axis(group, order, start, 1)
    beyond = place >= length[:, None]
    group[beyond] = width + 1
    base = np.arange(rows, dtype=np.int64)[:, None] * width
    size = np.bincount((base + group)[~beyond], minlength=rows * width).astype(np.int32)
    before = np.zeros((rows, width + 1), np.int16)
    named = np.flatnonzero(size)
    row, name = named // width, named % width
    before[row, name + size[named]] = name
    return group, size, before.ravel()


def lyndon_groups(text: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each suffix by its longest Lyndon prefix, and its previous-smaller pointer, as a flat place.

    Groups are taken from the largest down. A pointer leads from a suffix to the nearest one before it that is in a smaller group; the
    suffixes that are pointed at have a prefix that goes on with the group's, and move, by how many pointers they get, into
    groups right behind their own.
    """
    rows, width = text.shape
    group, size, before = _first_groups(text, length)
    flat = group.ravel()
    # Until a group's turn, a pointer leads one place back. Afterwards it is final.
    pointer = np.arange(-1, rows * width - 1, dtype=np.int32)
    pointer[::width] = _NONE
    active = np.flatnonzero(length > 1).astype(np.int32)
    bound = length[active].astype(np.int32)
    while len(active):
        current = before[active * np.int32(width + 1) + bound]
        dense = group if len(active) == rows else group[active]
        found = np.flatnonzero((dense == current[:, None]).ravel()).astype(np.int32)
        member = found // np.int32(width)
        at = found + (active[member] - member) * np.int32(width)
        of = current[member]
        target = pointer[at]
        seek = np.flatnonzero((target >= 0) & (flat[target] >= of))
        while len(seek):
            further = pointer[target[seek]]
            target[seek] = further
            pointer[at[seek]] = further
            seek = seek[(further >= 0) & (flat[further] >= of[seek])]
        _move(target[target >= 0], flat, size, before, width)
        going = current > 1
        active, bound = active[going], current[going]
    return group, pointer


def _move(target: np.ndarray, flat: np.ndarray, size: np.ndarray, before: np.ndarray, width: int) -> None:
    """Put the suffixes at `target` (ascending, once per pointer) into groups right behind their own."""
    if not len(target):
        return
    first = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1])))
    moved, count = target[first], np.diff(np.append(first, len(target)))
    old = moved - moved % np.int32(width) + flat[moved]
    can_split = size[old] > 1
    moved, count, old = moved[can_split], count[can_split], old[can_split]
    if not len(moved):
        return
    order = np.lexsort((-count, old))
    moved, count, old = moved[order], count[order], old[order]
    other = np.concatenate(([True], old[1:] != old[:-1]))
    opens = other | np.concatenate(([True], count[1:] != count[:-1]))
    head, sub = np.flatnonzero(other), np.flatnonzero(opens)
    total = np.diff(np.append(head, len(old)))
    ends = np.append(sub[1:], len(old))
    of_head = np.cumsum(other)[sub] - 1
    group = old[sub]  # row * width + name of the old group
    start = group + size[group] - (ends - head[of_head])
    size[old[head]] -= total.astype(np.int32)
    left = head[size[old[head]] > 0]
    row = old[left] // width
    before[old[left] + size[old[left]] + row] = old[left] % width
    own = ends - sub
    size[start] = own
    row = group // width
    before[start + own + row] = start % width
    flat[moved] = np.repeat(start % width, own)


def suffix_arrays(text: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The starts of each row's suffixes in lexicographic order, -1 past its length.

    `text` has a row of letters (uint8) per text. The last letter of a row, at `length - 1`, is smaller than all others of the row; what is
    behind it does not matter; rows are shorter than 32,000. Once the groups are known, suffixes come out in order: whichever is next shows
    which suffix is next in the groups of those that end where it begins, along the previous-smaller pointers.
    """
    rows, width = text.shape
    padded = np.where(np.arange(width) < length[:, None], text, 255).astype(np.uint8)
    group, pointer = lyndon_groups(padded, length)
    flat = group.ravel()
    out = np.full(rows * width, _NONE, np.int16)
    base = np.arange(rows, dtype=np.int32) * np.int32(width)
    some = length > 0
    out[base[some]] = length[some] - 1
    free = np.tile(np.arange(width, dtype=np.int16), rows)
    placed = np.zeros(rows * width, bool)
    placed[base[some] + length[some] - 1] = True
    for rank in range(int(length.max(initial=0))):
        row = np.flatnonzero(length > rank)
        start = out[base[row] + rank]
        row, start = row[start > 0], start[start > 0]
        origin = base[row]
        at = origin + start - 1
        while True:
            fresh = ~placed[at]
            at, origin = at[fresh], origin[fresh]
            if not len(at):
                break
            slot = origin + flat[at]
            out[origin + free[slot]] = at - origin
            free[slot] += 1
            placed[at] = True
            at = pointer[at]
            on = at >= 0
            at, origin = at[on], origin[on]
    return out.reshape(rows, width)
