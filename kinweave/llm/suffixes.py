"""Suffix arrays by induced sorting, and their permuted common prefixes."""

from __future__ import annotations

import numpy as np


def _s_types(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one after them; the last, a unique least, is."""
    step = np.sign(text[1:] - text[:-1])
    n = len(text)
    # Within a run of equal symbols the step after the run decides.
    decided = np.where(step != 0, np.arange(n - 1), n - 1)
    decided = np.minimum.accumulate(decided[::-1])[::-1]
    return np.append(np.append(step, 1)[decided] > 0, True)


def _before(text: np.ndarray, s_type: np.ndarray) -> tuple[list[int], list[int]]:
    """For each suffix the first symbol of the one before it, if that is larger or smaller than
    its successor, and else -1. A place of -1, as in the empty slots of an array, has none."""
    larger = np.full(len(text) + 1, -1, dtype=np.int64)
    smaller = larger.copy()
    larger[1:-1] = np.where(s_type[:-1], -1, text[:-1])
    smaller[1:-1] = np.where(s_type[:-1], text[:-1], -1)
    return larger.tolist(), smaller.tolist()


def _induced(
    text: list[int], before: tuple[list[int], list[int]], counts: np.ndarray, order: list[int]
) -> list[int]:
    """All suffixes from the leftmost-smaller ones in ``order``, in two linear scans."""
    ends = np.cumsum(counts)
    array = [-1] * len(text)
    tail = ends.tolist()
    for i in reversed(order):
        c = text[i]
        tail[c] -= 1
        array[tail[c]] = i
    larger, smaller = before
    head = (ends - counts).tolist()
    for i in array:  # larger suffixes, from the front; the list fills ahead of the scan
        c = larger[i]
        if c >= 0:
            at = head[c]
            array[at] = i - 1
            head[c] = at + 1
    tail = ends.tolist()
    for i in reversed(array):  # smaller suffixes, from the back, where it fills behind
        c = smaller[i]
        if c >= 0:
            tail[c] = at = tail[c] - 1
            array[at] = i - 1
    return array


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of whole numbers from 0 whose last, and no other, is 0.

    Leftmost-smaller substrings are sorted by a first induction and named; unless all names
    differ, the suffixes of the string of names are sorted the same way. Their order induces
    the order of all.
    """
    text = np.asarray(text, dtype=np.int64)
    if len(text) == 1:
        return np.zeros(1, dtype=np.int64)
    s_type = _s_types(text)
    left = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    symbols, before, counts = text.tolist(), _before(text, s_type), np.bincount(text)
    rough = np.array(_induced(symbols, before, counts, left.tolist()))
    is_left = np.zeros(len(text), dtype=bool)
    is_left[left] = True
    by_substring = rough[is_left[rough]]
    end = np.full(len(text), len(text), dtype=np.int64)
    end[left[:-1]] = left[1:] + 1
    width = 4
    raw = text.astype(np.int32).tobytes()
    names = np.zeros(len(text), dtype=np.int64)
    name, last = 0, None
    for i, e in zip(by_substring.tolist(), end[by_substring].tolist()):
        part = raw[i * width : e * width]
        if last is not None and part != last:
            name += 1
        names[i], last = name, part
    if name + 1 < len(left):
        order = left[suffix_array(names[left])]
    else:
        order = by_substring
    return np.array(_induced(symbols, before, counts, order.tolist()))


def permuted_prefixes(text: np.ndarray, array: np.ndarray) -> np.ndarray:
    """For each place, the common prefix of its suffix with the one sorted before it.

    Walked in the order of the text, the prefix shrinks by one at most from place to place,
    so all comparisons together are linear. The first in order has 0.
    """
    n = len(text)
    before = np.full(n, -1, dtype=np.int64)
    before[array[1:]] = array[:-1]
    symbols, found, length = text.tolist(), [0] * n, 0
    for i, j in enumerate(before.tolist()):
        if j < 0:
            length = 0
            continue
        while symbols[i + length] == symbols[j + length]:
            length += 1
        found[i] = length
        if length:
            length -= 1
    return np.array(found)


def repeated_starts(
    parts: list[np.ndarray], weights: np.ndarray, window: int
) -> list[np.ndarray]:
    """In each part, the starts of windows that occur more than once among all the parts.

    Parts hold whole numbers from 0; one counts ``weights`` times. The parts stand in one text
    between equal marks; a window lies within one part, and equal windows are neighbours in
    the suffix array.
    """
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    joined = np.concatenate(parts).astype(np.int64) + 2
    first = np.cumsum(sizes + 1) - sizes - 1
    text = np.ones(int(sizes.sum()) + len(parts) + 1, dtype=np.int64)
    text[-1] = 0
    owner = np.repeat(np.arange(len(parts)), sizes)
    nth = np.arange(len(joined)) - (np.cumsum(sizes) - sizes)[owner]
    place = first[owner] + nth
    text[place] = joined
    array = suffix_array(text)
    prefixes = permuted_prefixes(text, array)
    room = np.zeros(len(text), dtype=np.int64)
    room[place] = sizes[owner] - nth
    of = np.full(len(text), -1, dtype=np.int64)
    of[place] = owner
    # A suffix too short for a window shares no full window with its neighbour.
    group = np.cumsum(prefixes[array] < window)
    valid = room[array] >= window
    starts, group = array[valid], group[valid]
    times = np.bincount(group, weights[of[starts]])
    again = np.sort(starts[times[group] > 1])
    cut = np.searchsorted(again, np.append(first, len(text)))
    return [again[a:b] - f for a, b, f in zip(cut[:-1], cut[1:], first)]
