"""Rolling codes and anchors of windows, shared by the two kinds of repeat search."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = np.uint64(0xD6E8FEB86659FD93)
# Low bits of an anchor's rank hold its place in a stretch of this size.
PLACE_BITS = 24
STRETCH = 1 << 22


class Powers:
    """Powers of the base and of its inverse modulo 2^64, kept from text to text."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            one = np.ones(1, dtype=np.uint64)
            for name, factor in (("up", BASE), ("down", INVERSE)):
                steps = np.full(size - 1, factor, dtype=np.uint64)
                setattr(self, name, np.cumprod(np.concatenate([one, steps])))
        return self.up[:n], self.down[:n]


def codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """A 64-bit code of each stretch data[start:end], equal for equal bytes."""
    up, down = powers.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    code = (sums[ends] - sums[starts]) * down[starts]
    code ^= code >> np.uint64(32)
    code *= MIX
    return code ^ (code >> np.uint64(29))


def anchors(code: np.ndarray, width: int) -> np.ndarray:
    """Place of the least code, the leftmost of equals, among each ``width`` in a row.

    Which place is chosen depends on the codes alone, so equal windows choose alike. Blocks of
    ``width`` give running minima from both sides; a window's least is the lesser of two.
    """
    n = len(code) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    found = np.empty(n, dtype=np.int64)
    for at in range(0, n, STRETCH):
        part = code[at : min(at + STRETCH, n) + width - 1]
        rank = (part >> np.uint64(PLACE_BITS)) << np.uint64(PLACE_BITS)
        rank |= np.arange(len(part), dtype=np.uint64)
        blocks = -(-len(part) // width)
        grid = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
        grid[: len(part)] = rank
        grid = grid.reshape(blocks, width)
        left = np.minimum.accumulate(grid, axis=1).ravel()
        right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        m = len(part) - width + 1
        least = np.minimum(right[:m], left[width - 1 : width - 1 + m])
        found[at : at + m] = at + (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    return found


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in any [start, end)."""
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0
