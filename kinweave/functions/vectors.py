"""Small numpy helpers that run inside tasks on Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

METRICS = ("cosine", "l2", "dot")
# Scores are ranked after rounding, so that sums taken in another order (other batch
# sizes, other machines) cannot reorder neighbours that are equal.
SCORE_DIGITS = 12
# Distances of points to centres that are held at a time.
DISTANCE_CELLS = 1 << 20
# Columns of a matrix product whose maximum is taken before the best are looked for.
SET_COLUMNS = 16
# How far a matrix product may be off the pair-by-pair score.
_SLACK = 1e-9


def matrix(column: pa.Array | pa.ChunkedArray, kind: str = "f8") -> np.ndarray:
    """List column to a matrix, one row per vector: of doubles, or of another ``kind``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    if n == 0:
        return flat.reshape(0, 0)
    if flat.size % n or len(set(np.diff(column.offsets.to_numpy()))) > 1:
        raise ValueError("vectors differ in length")
    return flat.reshape(n, -1)


def list_column(rows: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Matrix to a list column."""
    n, dim = rows.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * dim)
    return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel(), type=kind))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; a zero row stays zero."""
    norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def prepare(rows: np.ndarray, metric: str) -> np.ndarray:
    return unit(rows) if metric == "cosine" else rows


def pair_scores(left: np.ndarray, right: np.ndarray, metric: str) -> np.ndarray:
    """Score of each row pair; ``1 - score`` is the distance."""
    if metric == "l2":
        gap = left - right
        score = 1.0 - np.sqrt(np.einsum("ij,ij->i", gap, gap))
    else:
        score = np.einsum("ij,ij->i", left, right)
    return np.round(score, SCORE_DIGITS) + 0.0


def nearest(
    left: np.ndarray, right: np.ndarray, k: int, metric: str, cells: int = 4_000_000
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best rows of ``right`` for each row of ``left`` (both prepared).

    ``right`` is in id order, so equal scores keep the smaller id. A matrix product
    picks the candidates, their scores are then computed pair by pair. Works on
    slices of ``left`` that keep the product below ``cells`` entries.
    """
    m = len(right)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if m == 0 or len(left) == 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(0)
    right_sq = np.einsum("ij,ij->i", right, right) if metric == "l2" else None
    scale = 1.0 + float(np.abs(right).max()) ** 2 * right.shape[1]
    step = max(1, cells // m)
    # Products of single precision choose the candidates where its errors are small: they are off
    # by at most the summed roundings of all terms, which widen the choice. Scores are never taken
    # from them.
    longest = float(np.sqrt(max(np.einsum("ij,ij->i", x, x).max() for x in (left, right))))
    single = metric != "l2" and 1e-6 < longest < 1e6
    wide = 2.0 * (right.shape[1] + 8) * float(np.finfo(np.float32).eps) * longest**2
    left_of, right_of = (x.astype(np.float32) if single else x for x in (left, right))
    for start in range(0, len(left), step):
        part = left[start : start + step]
        product = left_of[start : start + step] @ right_of.T
        if right_sq is not None:
            product = 2.0 * product - right_sq
        slack = wide if single else _SLACK * (scale + float(np.abs(product).max()))
        if m > k:
            # The k-th of the maxima of disjoint sets of columns is at most the k-th of all, and
            # far cheaper to find.
            sets = max(k, m // SET_COLUMNS)
            depth = m // sets
            tops = product[:, : depth * sets].reshape(len(part), depth, sets).max(axis=1)
            cut = np.partition(tops, sets - k, axis=1)[:, sets - k].astype(np.float64) - slack
            if single:
                cut = np.nextafter(cut.astype(np.float32), np.float32(-np.inf))
            li, ri = np.nonzero(product >= cut[:, None])
        else:
            li, ri = (a.ravel() for a in np.indices(product.shape))
        score = pair_scores(part[li], right[ri], metric)
        order = np.lexsort((ri, -score, li))
        li, ri, score = li[order], ri[order], score[order]
        first = np.searchsorted(li, li, side="left")
        keep = np.arange(len(li)) - first < k
        found.append((li[keep] + start, ri[keep], score[keep]))
    return tuple(np.concatenate(parts) for parts in zip(*found))  # type: ignore[return-value]


def as_points(rows: np.ndarray, metric: str, side: str, radius: float) -> np.ndarray:
    """Points whose Euclidean distance orders pairs as the metric does.

    Zero vectors get a direction of their own (cosine: score 0 to everything); for the
    dot product all right points are lifted to one sphere of the given ``radius``.
    """
    n = len(rows)
    if metric == "l2":
        return rows
    if metric == "cosine":
        points = unit(rows)
        is_zero = (~points.any(axis=1)).astype(np.float64)
        own, other = is_zero, np.zeros(n)
        extra = (own, other) if side == "left" else (other, own)
        return np.column_stack([points, *extra])
    if side == "left":
        return np.column_stack([unit(rows), np.zeros(n)])
    lift = radius**2 - np.einsum("ij,ij->i", rows, rows)
    return np.column_stack([rows, np.sqrt(np.maximum(lift, 0.0))])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0.0))


def nearest_centre(
    points: np.ndarray, centres: np.ndarray, cells: int = DISTANCE_CELLS
) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point and the distance to it, without all distances at once."""
    cell, gap = np.empty(len(points), np.int64), np.empty(len(points))
    step = max(1, cells // max(1, len(centres)))
    for start in range(0, len(points), step):
        gaps = distances(points[start : start + step], centres)
        part = gaps.argmin(axis=1)
        cell[start : start + step] = part
        gap[start : start + step] = gaps[np.arange(len(part)), part]
    return cell, gap
