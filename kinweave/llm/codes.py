"""Vector code compression: codebooks per part of a vector, learned over tries of distinct parts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.session import materialise

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
# Bytes of a stored component: big-endian and shifted to be positive, so that the order of the
# bytes is the order of the numbers.
WIDTH = 4
SHIFT = 1 << 31
# Components are held within this, so that no squared distance of up to 128 places overflows.
MOST = (1 << 27) - 1
# Nodes of one depth whose distances a traversal holds at a time.
BLOCK_NODES = 4096
# Vectors whose parts are made distinct together before the shuffle.
GROUP_ROWS = 1 << 15
# Label totals of so many rows are sent to every task; larger ones are joined by shuffle.
BROADCAST_LABELS = 100_000


class Trie:
    """Sorted distinct parts as a trie with a level for each place of a part.

    A node is the stretch of parts that share a prefix; ``starts[d]`` holds the first part of
    every node of depth d. The last level has a node for each part.
    """

    def __init__(self, parts: np.ndarray) -> None:
        self.parts = parts
        new = np.ones(parts.shape, dtype=bool)
        new[1:] = np.logical_or.accumulate(parts[1:] != parts[:-1], axis=1)
        self.starts = [np.flatnonzero(new[:, d]) for d in range(parts.shape[1])]

    def leaves(self, entries: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        """Stretches of parts, from first to last, with the squared distances to all entries.

        Depth first: a block of nodes adds its one place to the sums of its parents, and its
        children come before the nodes to the right of it. So each prefix is summed once, and
        one block a level is held.
        """
        last = len(self.starts) - 1
        stack = [(0, 0, len(self.starts[0]), np.zeros((1, len(entries)), np.int64), None)]
        while stack:
            depth, begin, end, sums, parent = stack.pop()
            if end - begin > BLOCK_NODES:
                stack.append((depth, begin + BLOCK_NODES, end, sums, parent))
                end = begin + BLOCK_NODES
            first = self.starts[depth][begin:end]
            if parent is not None:
                sums = sums[np.searchsorted(self.starts[depth - 1], first, "right") - 1 - parent]
            gap = self.parts[first, depth][:, None] - entries[:, depth]
            sums = sums + gap * gap
            if depth == last:
                yield slice(begin, end), sums
                continue
            stop = self.starts[depth][end] if end < len(self.starts[depth]) else len(self.parts)
            down = np.searchsorted(self.starts[depth + 1], [first[0], stop])
            stack.append((depth + 1, int(down[0]), int(down[1]), sums, begin))

    def nearest(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry, the lowest of equals, and its distance, for each part."""
        code = np.empty(len(self.parts), np.int64)
        distance = np.empty(len(self.parts), np.int64)
        for where, sums in self.leaves(entries):
            code[where] = sums.argmin(axis=1)
            distance[where] = sums.min(axis=1)
        return code, distance


def _packed(values: np.ndarray) -> np.ndarray:
    return (values + SHIFT).astype(">u4")


def _unpacked(raw: np.ndarray) -> np.ndarray:
    return raw.astype(np.int64) - SHIFT


def _distinct(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct rows of packed parts, each row's place among them, their numbers."""
    whole = np.ascontiguousarray(parts).view(f"V{parts.shape[1] * WIDTH}").ravel()
    found, place, times = np.unique(whole, return_inverse=True, return_counts=True)
    return found.view(">u4").reshape(len(found), -1), place.ravel(), times


def quantised(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(_id, _label, _size, _vec) of the proper vectors: floor(4096 x) as packed bytes."""
    schema = T.StructType(
        [
            T.StructField("_id", vectors.schema[id_col].dataType),
            T.StructField("_label", vectors.schema[label_col].dataType),
            T.StructField("_size", T.IntegerType()),
            T.StructField("_vec", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ends = lists.offsets.to_numpy()
            sizes = np.diff(ends)
            inner = lists.values.slice(ends[0], ends[-1] - ends[0])
            values = inner.to_numpy(zero_copy_only=False).astype(np.float64)
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            good = lists.is_valid().to_numpy(zero_copy_only=False).copy()
            good[owner[~np.isfinite(values) | inner.is_null().to_numpy(zero_copy_only=False)]] = False
            with np.errstate(over="ignore"):
                whole = np.clip(np.floor(SCALE * values[good[owner]]), -MOST, MOST)
            sizes = sizes[good].astype(np.int32)
            ends = np.concatenate([[0], np.cumsum(sizes * WIDTH)]).astype(np.int32)
            data = _packed(whole.astype(np.int64)).tobytes()
            packed = pa.Array.from_buffers(
                pa.binary(), len(sizes), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)]
            )
            at = np.flatnonzero(good)
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(take),
                    batch.column(1).take(take),
                    pa.array(sizes, pa.int32()),
                    packed,
                ],
                names=schema.names,
            )

    rows = vectors.select(
        F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), F.col(vector_col).alias("_vec")
    )
    return rows.mapInArrow(run, schema)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Packed vectors as rows of 8 * width places; missing places at the end are 0."""
    blank = _packed(np.zeros(PARTS * width, np.int64)).tobytes()
    joined = b"".join(v + blank[len(v) :] for v in column.to_pylist())
    return np.frombuffer(joined, dtype=">u4").reshape(-1, PARTS, width)


def distinct_parts(vecs: DataFrame, width: int) -> DataFrame:
    """(pos, part, weight): each distinct part of a position once, in stretches of its order.

    A task combines its own copies first, so a part that a third of all rows hold is shuffled
    once for each group of rows. Ranges of whole parts are shuffled, so neither a common part
    nor a common prefix makes a task larger than others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _grouped(batches):
            rows = _matrix(batch.column("_vec"), width)
            for pos in range(PARTS):
                found, _, times = _distinct(rows[:, pos])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(found), pos, np.int32)),
                        pa.array([p.tobytes() for p in found], pa.binary()),
                        pa.array(times.astype(np.int64)),
                    ],
                    names=["pos", "part", "weight"],
                )

    parts = vecs.select("_vec").mapInArrow(run, "pos int, part binary, weight long")
    return (
        parts.repartitionByRange("pos", "part")
        .groupBy("pos", "part")
        .agg(F.sum("weight").alias("weight"))
        .sortWithinPartitions("pos", "part")
    )


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches joined to groups of a bounded number of rows."""
    group, size = [], 0
    for batch in batches:
        if batch.num_rows:
            group.append(batch)
            size += batch.num_rows
        if size >= GROUP_ROWS:
            yield pa.Table.from_batches(group).combine_chunks()
            group, size = [], 0
    if group:
        yield pa.Table.from_batches(group).combine_chunks()


def moved(parts: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round over all distinct parts; unused entries stay.

    A task sends on one row for each entry and place; the driver gets their totals.
    """
    n_entries, width = books.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last place holds the number of parts.
        totals = np.zeros((PARTS, n_entries, width + 1), np.int64)
        for batch in batches:
            where = batch.column(0).to_numpy()
            raw = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=">u4")
            rows = _unpacked(raw.reshape(-1, width))
            weight = batch.column(2).to_numpy()[:, None]
            for pos in np.unique(where):
                of_pos = where == pos
                code, _ = Trie(rows[of_pos]).nearest(books[pos])
                weighted = np.column_stack([rows[of_pos] * weight[of_pos], weight[of_pos]])
                np.add.at(totals[pos], code, weighted)
        used = np.argwhere(np.broadcast_to(totals[:, :, -1:] > 0, totals.shape))
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array(used[:, k].astype(np.int32)) for k in range(3)),
                pa.array(totals[tuple(used.T)]),
            ],
            names=["pos", "entry", "place", "total"],
        )

    sums = (
        parts.mapInArrow(run, "pos int, entry int, place int, total long")
        .groupBy("pos", "entry", "place")
        .agg(F.sum("total").alias("total"))
    )
    totals = np.zeros((PARTS, n_entries, width + 1), np.int64)
    for row in sums.collect():  # 8 * 16 * (width + 1) rows at most
        totals[row["pos"], row["entry"], row["place"]] = row["total"]
    number = totals[:, :, -1:]
    return np.where(number > 0, totals[:, :, :-1] // np.maximum(number, 1), books)


def first_books(vecs: DataFrame, width: int) -> np.ndarray:
    """The parts of the vectors of the 16 smallest ids; NULL ids come last, then the bytes."""
    order = [F.col("_id").asc_nulls_last(), F.col("_vec")]
    first = [bytes(r["_vec"]) for r in vecs.orderBy(*order).limit(ENTRIES).select("_vec").collect()]
    rows = _unpacked(_matrix(pa.array(first, pa.binary()), width))
    return rows.transpose(1, 0, 2)


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def coded(vecs: DataFrame, books: np.ndarray) -> DataFrame:
    """(_id, _label, code, error) of every vector; a batch shares a trie for each position."""
    width = books.shape[2]
    schema = T.StructType(
        [
            vecs.schema["_id"],
            vecs.schema["_label"],
            T.StructField("code", T.StringType()),
            T.StructField("error", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(2), width)
            code = np.zeros((len(rows), PARTS), np.uint8)
            error = np.zeros(len(rows), np.int64)
            for pos in range(PARTS if len(rows) else 0):
                found, place, _ = _distinct(rows[:, pos])
                nearest, distance = Trie(_unpacked(found)).nearest(books[pos])
                code[:, pos] = nearest[place]
                error += distance[place]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([c.tobytes().hex() for c in code], pa.string()),
                    pa.array(error),
                ],
                names=schema.names,
            )

    return vecs.select("_id", "_label", "_vec").mapInArrow(run, schema)


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """Codes of all proper vectors, as (id, label, code, error, label_error), and the codebooks.

    Components become floor(4096 x), held within 27 bits. Each of the 8 parts of a vector is
    coded by the nearest of 16 entries of its position, which ``rounds`` rounds of means move.
    A vector that is NULL or has a NULL or non-finite component is dropped. Rows with a NULL id
    are coded too; repeated rows count as often as they come, and of equal ids the smaller
    vector begins first. Fewer than 16 vectors make as many entries. Vectors shorter than the
    longest, or not of 8 equal parts, get zeros at their end. Other columns are not read; an
    empty input gives no rows and empty codebooks.

    ``label_error`` is the sum of errors of equal labels; all NULL labels are one.
    """
    vecs = materialise(quantised(vectors, id_col, vector_col, label_col), "codes-vectors")
    size, n = vecs.agg(F.max("_size"), F.count(F.lit(1))).first()
    width = max(1, -(-(size or 0) // PARTS))
    books = np.zeros((PARTS, 0, width), np.int64)
    if n:
        books = first_books(vecs, width)
        parts = materialise(distinct_parts(vecs, width), "codes-parts")
        for _ in range(rounds):
            books = moved(parts, books)
    rows = materialise(coded(vecs, books), "codes-coded")
    total = materialise(
        rows.groupBy(F.col("_label").alias("_of")).agg(F.sum("error").alias("label_error")),
        "codes-labels",
    )
    if total.count() <= BROADCAST_LABELS:
        total = F.broadcast(total)
    same: Column = F.col("_label").eqNullSafe(F.col("_of"))
    found = rows.join(total, same, "left").select(
        F.col("_id").alias(id_col), F.col("_label").alias(label_col), "code", "error", "label_error"
    )
    return found, books
