"""Approximate nearest neighbours through signatures that are stored in blocks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.functions.checks import vector_ok
from kinweave.functions.vectors import METRICS, as_points, matrix, nearest, prepare, unit
from kinweave.operators.inverted import largest_norm
from kinweave.operators.keys import top_k_per_group
from kinweave.operators.neighbours import score_groups
from kinweave.operators.numbering import assign_index
from kinweave.session import materialise, shared_path

# What is stored with an index.
SETTINGS = (
    "tables int, bits int, seed long, metric string, radius double, mean array<double>, "
    "spread double, blocks long, n long"
)
BLOCK_ROWS = 512
# Blocks of all tables, whose bounds every task holds: 16 bytes each.
MOST_BLOCKS = 1 << 20
# Left rows and their bytes that are sent to the index instead of meeting it in a shuffle, and
# the candidates they may have for that.
SMALL_ROWS, SMALL_BYTES, SMALL_CANDIDATES = 4096, 32 << 20, 1 << 20
# Projections whose digits make up a signature for l2, and how many deviations they reach.
PROJECTIONS, REACH = 6, 4.0


@dataclass(frozen=True)
class Signer:
    """How vectors get their signatures.

    Cosine: the signs of random projections. Dot product: the same after the stored vectors are
    lifted to one sphere, where a larger product is a smaller angle. l2: stable projections,
    cut into equal steps, whose digits are interleaved, so that vectors near each other agree
    in the leading digits of most projections.
    """

    tables: int
    bits: int
    seed: int
    metric: str
    radius: float = 0.0
    mean: tuple[float, ...] = ()
    spread: float = 0.0

    def _planes(self, dim: int, table: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        # Each table has its own generator: adding tables leaves the earlier ones as they are.
        rng = np.random.default_rng([self.seed, table])
        return rng.standard_normal((dim, n)), rng.random(n)

    def signatures(self, vectors: np.ndarray, side: str) -> np.ndarray:
        """One row of signatures, one for each table, for each vector."""
        if self.metric == "l2":
            return self._interleaved(vectors - np.asarray(self.mean))
        points = unit(vectors) if self.metric == "cosine" else as_points(vectors, "dot", side, self.radius)
        weights = 1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64)
        columns = []
        for table in range(self.tables):
            planes, _ = self._planes(points.shape[1], table, self.bits)
            columns.append((np.round(points @ planes, 9) >= 0) @ weights)
        return np.column_stack(columns)

    def _interleaved(self, vectors: np.ndarray) -> np.ndarray:
        digits = max(1, self.bits // PROJECTIONS)
        most = 1 << digits
        width = 2 * REACH * self.spread / most or 1.0
        columns = []
        for table in range(self.tables):
            planes, shift = self._planes(vectors.shape[1], table, PROJECTIONS)
            steps = np.floor(np.round(vectors @ planes, 9) / width + shift).astype(np.int64) + most // 2
            steps = np.clip(steps, 0, most - 1)
            code = np.zeros(len(vectors), np.int64)
            for digit in range(digits - 1, -1, -1):
                for j in range(PROJECTIONS):
                    code = (code << 1) | ((steps[:, j] >> digit) & 1)
            columns.append(code)
        return np.column_stack(columns)


@dataclass(frozen=True)
class VectorIndex:
    """``rows`` has (id, vector) and the signature of each table with a hash of the id, in whose
    order the rows of a table are cut into blocks; ``bounds`` the first signature and hash and the
    size of each block. A block number is table * ``blocks`` + place."""

    rows: DataFrame
    bounds: DataFrame
    signer: Signer
    blocks: int
    n: int

    @property
    def entries(self) -> DataFrame:
        """(block, id): each row once for each table."""
        return _entries(self, _Finder(self))

    @property
    def tables(self) -> int:
        return self.signer.tables

    @property
    def bits(self) -> int:
        return self.signer.bits

    @property
    def seed(self) -> int:
        return self.signer.seed


def _moments(rows: DataFrame, dim: int) -> tuple[tuple[float, ...], float]:
    """Mean vector, and the root of the mean squared distance to it."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros(dim + 1), 0
        for batch in batches:
            vectors = matrix(batch.column(0))
            if len(vectors):
                sums[:dim] += vectors.sum(axis=0)
                sums[dim] += (vectors * vectors).sum()
                n += len(vectors)
        places = np.arange(dim + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(places), pa.array(sums), pa.array(np.full(dim + 1, n))], names=["place", "total", "n"]
        )

    parts = rows.select("vector").mapInArrow(total, "place long, total double, n long")
    found = parts.groupBy("place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    # Rounded, so that another order of summing does not move a vector to another step.
    means = [float(np.format_float_positional(r["total"] / r["n"], 9, fractional=False))
             for r in found.orderBy("place").collect()]
    mean = np.asarray(means[:dim])
    spread = np.sqrt(max(0.0, means[dim] - float((mean * mean).sum())))
    return tuple(means[:dim]), float(np.round(spread, 9))


def _signed(rows: DataFrame, signer: Signer) -> DataFrame:
    """Rows with ``signatures``, one for each table."""
    schema = T.StructType([*rows.schema.fields, T.StructField("signatures", T.ArrayType(T.LongType()))])
    at = rows.columns.index("vector")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            codes = signer.signatures(matrix(batch.column(at)), "right")
            ends = pa.array(np.arange(len(codes) + 1, dtype=np.int32) * signer.tables)
            lists = pa.ListArray.from_arrays(ends, pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=schema.names)

    return rows.mapInArrow(sign, schema)


def build_vector_index(
    df: DataFrame,
    *,
    id_col: str = "id",
    vector: str = "vector",
    metric: str = "cosine",
    tables: int = 8,
    bits: int = 48,
    seed: int = 0,
    block_rows: int = BLOCK_ROWS,
    dim: int | None = None,
    path: str | None = None,
) -> VectorIndex:
    """Sign every vector against ``tables`` sets of random planes and store the result.

    The ids of each table are stored in signature order and cut into blocks of ``block_rows``
    (more, if there would be more than a million blocks), so the order is made once and not by
    each search. A signature shared by very many rows is spread over blocks by a hash of the
    id. Ids are unique. Vectors with a NULL, NaN or infinite element, or of another length than
    ``dim``, are left out.
    """
    if not 1 <= bits <= 62:
        raise ValueError("bits must be between 1 and 62")
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    spark, target = df.sparkSession, path or shared_path(df.sparkSession, "index")
    good = df.filter(vector_ok(F.col(vector), dim)).select(
        F.col(id_col).alias("id"), F.col(vector).alias("vector")
    )
    # The measures of l2 and the dot product are taken over all rows, so these are stored first.
    stored = good if metric == "cosine" else materialise(good, "vectors")
    n, longest, radius, mean, spread = None, 0, 0.0, (), 0.0
    if metric != "cosine":
        n, longest = stored.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if n and metric == "dot":
        radius = largest_norm(stored)
    if n and metric == "l2":
        mean, spread = _moments(stored, longest)
    signer = Signer(tables, bits, seed, metric, radius, mean, spread)
    signed = _signed(stored.withColumn("_tie", F.xxhash64("id")), signer)
    signed.write.mode("overwrite").parquet(f"{target}/rows")
    rows = spark.read.schema(signed.schema).parquet(f"{target}/rows")
    n = rows.count()
    per_table = max(1, min(-(-n // block_rows), MOST_BLOCKS // tables))
    size = max(1, -(-n // per_table))
    # Signatures and hashes alone are put in order; ids and vectors stay where they are.
    entries = rows.select("_tie", F.posexplode("signatures").alias("_table", "_sig"))
    ordered = assign_index(entries, ["_table", "_sig", "_tie"], "_at")
    # Each table has every row once, so a place in all tells the place in its table.
    place = F.col("_at") - 1 - F.col("_table") * n
    block = (F.col("_table") * F.lit(per_table) + F.floor(place / size)).cast("long")
    bounds = (
        ordered.withColumn("_place", place)
        .filter(F.pmod("_place", F.lit(size)) == 0)
        .select(
            block.alias("block"),
            F.col("_sig").alias("first"),
            F.col("_tie").alias("tie"),
            F.least(F.lit(size), F.lit(n) - F.col("_place")).cast("long").alias("n"),
        )
    )
    bounds.write.mode("overwrite").parquet(f"{target}/bounds")
    settings = [(tables, bits, seed, metric, radius, list(mean), spread, per_table, n)]
    spark.createDataFrame(settings, SETTINGS).coalesce(1).write.mode("overwrite").parquet(
        f"{target}/settings"
    )
    return open_vector_index(spark, target)


def open_vector_index(spark: SparkSession, path: str) -> VectorIndex:
    """An index that :func:`build_vector_index` stored, with the settings it was built with."""
    kept = spark.read.schema(SETTINGS).parquet(f"{path}/settings").first()
    signer = Signer(
        kept["tables"], kept["bits"], kept["seed"], kept["metric"], kept["radius"],
        tuple(kept["mean"]), kept["spread"],
    )
    rows = spark.read.parquet(f"{path}/rows")
    bounds = spark.read.schema("block long, first long, tie long, n long").parquet(f"{path}/bounds")
    return VectorIndex(rows, bounds, signer, kept["blocks"], kept["n"])


class _Finder:
    """Finds the blocks of signatures by binary search over the bounds."""

    def __init__(self, index: VectorIndex) -> None:
        table = index.bounds.orderBy("block").toArrow()  # a million rows at most
        self.signer, self.blocks = index.signer, index.blocks
        self.block = table["block"].to_numpy()
        self.first, self.size = table["first"].to_numpy(), table["n"].to_numpy()
        self.tie = table["tie"].to_numpy()

    def parts(self) -> dict:
        """What a task needs to make the finder again; plain values, as those sent to tasks do not
        carry the code of this package."""
        return {**vars(self), "signer": vars(self.signer)}

    @classmethod
    def of(cls, parts: dict) -> _Finder:
        finder = cls.__new__(cls)
        vars(finder).update(parts, signer=Signer(**parts["signer"]))
        return finder

    def blocks_of(self, codes: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """The block of each table that holds a stored row: the last that begins not after it."""
        found = []
        for table in range(self.signer.tables):
            begin, end = np.searchsorted(self.block, np.array([table, table + 1]) * self.blocks)
            first, tie, sig = self.first[begin:end], self.tie[begin:end], codes[:, table]
            at = np.searchsorted(first, sig, "right") - 1
            # Blocks that begin with the same signature are told apart by the hash.
            low = np.searchsorted(first, sig, "left")
            for row in np.flatnonzero(first[at] == sig):
                at[row] = low[row] + np.searchsorted(tie[low[row] : at[row] + 1], ties[row], "right") - 1
            found.append(self.block[begin + np.maximum(at, 0)])
        return np.column_stack(found)

    def visits(self, vectors: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Two blocks of each table for each vector: its own and the one that begins or ends
        nearer. Where several blocks share its signature, the hash of the id chooses."""
        codes = self.signer.signatures(vectors, "left")
        found = []
        for table in range(self.signer.tables):
            begin, end = np.searchsorted(self.block, np.array([table, table + 1]) * self.blocks)
            first, sig = self.first[begin:end], codes[:, table]
            low = np.maximum(np.searchsorted(first, sig, "left") - 1, 0)
            high = np.maximum(np.searchsorted(first, sig, "right") - 1, 0)
            own = low + np.where(high > low + 1, ties % (high - low + 1), high - low)
            last = len(first) - 1
            up = np.minimum(own + 1, last)
            nearer = first[up].astype(float) - sig < sig - first[own].astype(float)
            beside = np.where((nearer & (own < last)) | (own == 0), up, own - 1)
            found += [begin + own, begin + beside]
        return self.block[np.column_stack(found)]


def _entries(index: VectorIndex, finder: _Finder) -> DataFrame:
    """(block, id): each stored row once for each table."""
    placed = _placed(index, finder, ["id"])
    return placed.select(F.explode("blocks").alias("block"), "id")


def _placed(index: VectorIndex, finder: _Finder, columns: list[str]) -> DataFrame:
    """``columns`` of the stored rows with their blocks."""
    shared = index.rows.sparkSession.sparkContext.broadcast(finder.parts())
    kept = index.rows.select("_tie", "signatures", *columns)
    schema = T.StructType([*kept.schema.fields[2:], T.StructField("blocks", T.ArrayType(T.LongType()))])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _Finder.of(shared.value)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            codes = matrix(batch.column(1), "i8")
            blocks = finder.blocks_of(codes, batch.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], _block_lists(blocks)], names=schema.names)

    return kept.mapInArrow(place, schema)


def _block_lists(blocks: np.ndarray) -> pa.ListArray:
    ends = pa.array(np.arange(len(blocks) + 1, dtype=np.int32) * blocks.shape[1])
    return pa.ListArray.from_arrays(ends, pa.array(blocks.ravel()))


def _hashes(ids: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A number from each id that does not depend on the run."""
    return np.fromiter((zlib.crc32(str(v).encode()) for v in ids.to_pylist()), np.int64)


def approximate_topk(
    left: DataFrame,
    index: VectorIndex,
    k: int = 3,
    *,
    left_id: str = "id",
    vector: str = "vector",
    exclude_self: bool = False,
    small_rows: int = SMALL_ROWS,
    group_rows: int = 8192,
) -> DataFrame:
    """Up to ``k`` near rows of the index for each left row: ``source_id, target_id,
    score, rank`` with exact scores of the index's metric.

    A left row looks at two blocks of each table, found by binary search over the stored
    bounds; nothing is put in order. A left side of checked small size is sent to the stored
    rows, which are neither shuffled nor sorted; otherwise left rows and the entries of the
    index meet by block, and left rows meeting in one block are split. The result does not
    depend on the partitioning.
    """
    lhs = left.filter(vector_ok(F.col(vector))).select(
        F.col(left_id).alias("source_id"), F.col(vector).alias("_vec")
    )
    keep, metric = k + exclude_self, index.signer.metric
    finder = _Finder(index)
    if not index.n:
        found = score_groups(
            lhs.withColumn("block", F.lit(0)),
            index.rows.select(F.col("id").alias("target_id"), F.col("vector").alias("_vec"), F.lit(0).alias("block")),
            ["block"], keep, metric, group_rows,
        )
        return top_k_per_group(found, ["source_id"], [F.col("score").desc(), "target_id"], k)
    n, n_bytes = left.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.coalesce(F.size(vector) * 8, F.lit(0))), F.lit(0))
    ).first()
    found = None
    if n <= small_rows and n_bytes <= SMALL_BYTES:
        found = _from_small(lhs, index, finder, keep)
    if found is None:
        found = _by_block(lhs, index, finder, keep, group_rows)
    if exclude_self:
        found = found.filter(F.col("source_id") != F.col("target_id"))
    # A pair found in several blocks has one score.
    return top_k_per_group(found.distinct(), ["source_id"], [F.col("score").desc(), "target_id"], k)


def _found(lhs: DataFrame, index: VectorIndex) -> T.StructType:
    return T.StructType(
        [
            lhs.schema["source_id"],
            T.StructField("target_id", index.rows.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _from_small(lhs: DataFrame, index: VectorIndex, finder: _Finder, keep: int) -> DataFrame | None:
    """Send the left rows to the stored vectors; None if they have too many candidates."""
    spark, metric = lhs.sparkSession, index.signer.metric
    table = lhs.toArrow().combine_chunks()
    if not table.num_rows:
        return spark.createDataFrame([], _found(lhs, index))
    vectors = matrix(table["_vec"])
    visits = finder.visits(vectors, _hashes(table["source_id"]))
    blocks, place = np.unique(visits, return_inverse=True)
    n_candidates = finder.size[np.searchsorted(finder.block, blocks)].sum()
    if n_candidates > SMALL_CANDIDATES:
        return None
    place = place.reshape(visits.shape)
    of_block = [np.flatnonzero((place == b).any(axis=1)) for b in range(len(blocks))]
    schema = _found(lhs, index)
    ids = table["source_id"].combine_chunks()
    shared = spark.sparkContext.broadcast((blocks, of_block, ids, prepare(vectors, metric)))
    wanted = spark.createDataFrame([(int(b),) for b in blocks], "block long")
    near = _entries(index, finder).join(F.broadcast(wanted), "block")
    # The candidates were counted; the stored vectors stream past them.
    rows = index.rows.join(F.broadcast(near), "id").select("id", "vector", "block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, of_block, ids, queries = shared.value
        for batch in batches:
            batch = batch.take(pc.sort_indices(batch, [("block", "ascending"), ("id", "ascending")]))
            number = batch.column(2).to_numpy()
            stored = prepare(matrix(batch.column(1)), metric) if batch.num_rows else None
            for block in np.unique(number):
                where = np.flatnonzero(number == block)
                asked = of_block[int(np.searchsorted(blocks, block))]
                li, ri, score = nearest(queries[asked], stored[where], keep, metric)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(asked[li])),
                        batch.column(0).take(pa.array(where[ri])),
                        pa.array(score),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(search, schema)


def _by_block(
    lhs: DataFrame, index: VectorIndex, finder: _Finder, keep: int, group_rows: int
) -> DataFrame:
    """Left rows and the vectors of the index meet by block."""
    shared = lhs.sparkSession.sparkContext.broadcast(finder.parts())
    schema = T.StructType([*lhs.schema.fields, T.StructField("blocks", T.ArrayType(T.LongType()))])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _Finder.of(shared.value)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            blocks = finder.visits(matrix(batch.column(1)), _hashes(batch.column(0)))
            yield pa.RecordBatch.from_arrays([*batch.columns, _block_lists(blocks)], names=schema.names)

    probed = materialise(lhs.mapInArrow(visit, schema), "probes")
    visits = probed.withColumn("blocks", F.array_distinct("blocks"))
    rights = _placed(index, finder, ["id", "vector"]).toDF("target_id", "_vec", "blocks")
    # Blocks are small groups: a task takes as many as have the rows of a large one, and those that
    # follow each other travel together, so that a left row is moved about once for each table.
    per_task = max(1, group_rows * index.blocks // index.n)
    return score_groups(visits, rights, ["block"], keep, index.signer.metric, group_rows, per_task, per_task)
