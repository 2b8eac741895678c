"""Rolling hashes, minimizers of fixed-length windows, and sparse count-min sketches of them: what both substring operators share.

Every window of `length` items holds `length - k + 1` runs of k items; its minimizer is the one with the smallest hash, the leftmost on
ties. Equal windows have equal minimizers, so a minimizer is in at least as many documents as any window that it stands for, and a sketch
that overestimates the former overestimates the latter.
"""

from __future__ import annotations

import numpy as np

_POSITION_BITS = 30
_MASK = np.uint64((1 << _POSITION_BITS) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and its inverse modulo 2 ** 64, for i < n at least."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        _powers[base] = (both[0], both[1])
    return _powers[base]


def rolling(items: np.ndarray, k: int, base: int = _BASE) -> np.ndarray:
    """Polynomial hashes of each k consecutive items (uint64)."""
    n = len(items)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = powers(n, base)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(items * up[:n], out=total[1:])
    return (total[k:] - total[:-k]) * down[: n - k + 1]


def minimizers(grams: np.ndarray, w: int) -> np.ndarray:
    """For each w consecutive hashes the position of the smallest (by its upper bits, the leftmost on ties)."""
    if len(grams) < w:
        return np.zeros(0, np.int64)
    low = grams * np.uint64(0xD6E8FEB86659FD93)
    low &= ~_MASK
    low |= np.arange(len(grams), dtype=np.uint64)
    reach = 1
    while 2 * reach <= w:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < w:
        low = np.minimum(low[: len(low) - (w - reach)], low[w - reach :])
    return (low & _MASK).astype(np.int64)


def runs(items: np.ndarray, bounds: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive windows with one minimizer: (text, first window's position in items, windows, minimizer hash).

    items: those of several texts on end; bounds: where each text starts, and the end. Windows lie within one text.
    """
    empty = np.zeros(0, np.int64)
    if len(items) < length:
        return empty, empty, empty, empty.astype(np.uint64)
    grams = rolling(items, k)
    place = minimizers(grams, length - k + 1)
    n = len(place)
    # The last windows' starts of a text, which would reach into the next one, are no windows.
    valid = np.ones(n, bool)
    for end in bounds[1:].tolist():
        valid[max(0, end - length + 1) : end] = False
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(place[1:], place[:-1], out=new[1:])
    new[1:] |= ~valid[:-1]
    new &= valid
    # A text of fewer items than a window has no valid start, so a run never spans texts.
    at = np.flatnonzero(new)
    stop = np.append(at[1:], n)
    gap = np.flatnonzero(~valid)
    if len(gap):
        following = np.searchsorted(gap, at)
        stop = np.minimum(stop, np.where(following < len(gap), gap[np.minimum(following, len(gap) - 1)], n))
    return np.searchsorted(bounds, at, "right") - 1, at, stop - at, grams[place[at]]


def mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return keys ^ (keys >> np.uint64(29))


def cells(keys: np.ndarray, slices: int) -> tuple[np.ndarray, np.ndarray]:
    """(slice, cell in the slice) of each key in a sketch of slices * 2 ** 32 cells."""
    m = mixed(keys)
    return ((m >> np.uint64(32)) % np.uint64(slices)).astype(np.int64), (m & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def sketched(text: np.ndarray, keys: np.ndarray, slices: int):
    """The sketch of some texts: (slice, its nonzero cells in order, whether each is 2 or more); a key counts once a text, and counts stop at 2."""
    part, cell = cells(keys, slices)
    joint = (part.astype(np.uint64) << np.uint64(32)) | cell
    order = np.lexsort((text, joint))
    joint, text = joint[order], text[order]
    if not len(joint):
        return
    once = np.concatenate([[True], (joint[1:] != joint[:-1]) | (text[1:] != text[:-1])])
    joint = joint[once]
    first = np.flatnonzero(np.concatenate([[True], joint[1:] != joint[:-1]]))
    many = np.diff(np.append(first, len(joint))) > 1
    joint = joint[first]
    part = (joint >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield int(part[a]), (joint[a:b] & np.uint64(0xFFFFFFFF)).astype(np.uint32), many[a:b]


def merged(sketches: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Of several sketches of one slice, as (cells, whether 2 or more): for each its cells that are 2 or more in their sum."""
    every = np.concatenate([c for c, _ in sketches])
    many = np.concatenate([m for _, m in sketches])
    order = np.argsort(every, kind="stable")
    ordered = every[order]
    same = ordered[1:] == ordered[:-1]
    again = np.zeros(len(every), bool)
    again[order[1:]] |= same
    again[order[:-1]] |= same
    # A cell that is 2 in one sketch is so in all.
    group = np.cumsum(np.concatenate([[True], ~same])) - 1 if len(every) else np.zeros(0, np.int64)
    full = np.zeros(group[-1] + 1 if len(group) else 0, bool)
    np.logical_or.at(full, group[many[order]], True)
    again[order] |= full[group]
    return np.split(again, np.cumsum([len(c) for c, _ in sketches])[:-1])
