"""Inverted file over a vector table: cells of k-means, stored apart, of which a search reads few."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.functions.checks import vector_ok
from kinweave.functions.vectors import (
    DISTANCE_CELLS,
    METRICS,
    as_points,
    distances,
    matrix,
    nearest_centre,
)
from kinweave.operators.keys import top_k_per_group
from kinweave.operators.neighbours import GROUP_ROWS, score_groups, score_to
from kinweave.session import materialise, shared_path

# What is stored with an index.
SETTINGS = "metric string, radius double, n long"
# Bounds: cells of an index, vectors the cells are learned from, and bytes of those.
MOST_CELLS = 4096
SAMPLE_PER_CELL = 64
SAMPLE_BYTES = 256 << 20
ROUNDS = 8
# Sampled vectors that are turned into points at a time.
DRIVER_ROWS = 8192
# Rows that one file of a cell holds, about.
FILE_ROWS = 1 << 17
SEED = 0


@dataclass(frozen=True)
class InvertedIndex:
    """``rows`` is partitioned by ``cell`` (id, vector and payload); ``cells`` has one row per
    cell: ``cell, centre, n, reach``, the last the distance of its farthest point."""

    rows: DataFrame
    cells: DataFrame
    metric: str
    radius: float
    n: int


def _norm(vector: str) -> Column:
    squares = F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return F.sqrt(squares)


def largest_norm(rows: DataFrame, vector: str = "vector") -> float:
    return float(rows.agg(F.max(_norm(vector))).first()[0] or 0.0)


def kmeans(points: np.ndarray, n_cells: int, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Centres of Lloyd's rounds. Each first centre is drawn far from those before it; a cell
    that loses all points moves to the point that is farthest from its own centre. Beside the
    points a few arrays of their number are held, never the distances of all points to all centres."""
    rng = np.random.default_rng(seed)
    centres = points[rng.integers(len(points))][None]
    least = 1e-6 * (1.0 + float(np.abs(points).max()))  # equal points, but for rounding
    gaps = nearest_centre(points, centres)[1]
    while len(centres) < min(n_cells, len(points)):
        weight = np.where(gaps > least, gaps, 0.0) ** 2
        if not weight.sum():
            break  # fewer different points than cells
        # Several at a time, so that many cells do not take as many passes.
        drawn = rng.choice(len(points), max(1, len(centres) // 2), p=weight / weight.sum())
        new = np.unique(points[drawn], axis=0)[: n_cells - len(centres)]
        centres = np.concatenate([centres, new])
        gaps = np.minimum(gaps, nearest_centre(points, new)[1])
    for _ in range(rounds):
        cell, near = nearest_centre(points, centres)
        size = np.bincount(cell, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, points)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
        lost = np.flatnonzero(size == 0)
        far = np.argsort(-near, kind="stable")[: len(lost)]
        centres[lost] = points[far]
    return centres


def _place(rows: DataFrame, centres: np.ndarray, metric: str, radius: float) -> DataFrame:
    """Add ``cell`` and ``_gap``, the nearest centre and the distance to it."""
    schema = T.StructType(
        [*rows.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("_gap", T.DoubleType())]
    )
    at = rows.columns.index("vector")
    shared = rows.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            points = as_points(matrix(batch.column(at)), metric, "right", radius)
            cell, gap = nearest_centre(points, shared.value)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(cell.astype(np.int32)),
                    pa.array(gap),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)


def build_inverted_index(
    df: DataFrame,
    *,
    id_col: str = "id",
    vector: str = "vector",
    payload: list[str] | None = None,
    metric: str = "cosine",
    cells: int | None = None,
    sample_per_cell: int = SAMPLE_PER_CELL,
    file_rows: int = FILE_ROWS,
    dim: int | None = None,
    seed: int = SEED,
    path: str | None = None,
) -> InvertedIndex:
    """Put every vector into the cell of its nearest centre and store the cells apart.

    The centres are learned by k-means from a sample: about ``sample_per_cell`` different vectors
    for each cell, chosen by their hash, at most 256 MB. The default number of cells is the root of the
    number of rows, at most 4,096. Vectors with a NULL, NaN or infinite element, or of another
    length than ``dim``, are left out. Cells are those of the metric: unit vectors for cosine,
    and for the dot product vectors lifted to one sphere. A large cell is several files, dealt
    out by a hash of the id, so no task writes a hot cell alone.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    spark, payload = df.sparkSession, payload or []
    good = df.filter(vector_ok(F.col(vector), dim)).select(
        F.col(id_col).alias("id"), F.col(vector).alias("vector"), *payload
    )
    h = F.xxhash64("vector")
    n, longest, radius, distinct = good.agg(
        F.count(F.lit(1)), F.max(F.size("vector")), F.max(_norm("vector")), F.approx_count_distinct(h)
    ).first()
    target = path or shared_path(spark, "inverted")
    wanted = cells or int(np.sqrt(n or 0)) or 1
    wanted = max(1, min(wanted, MOST_CELLS))
    most = max(wanted, min(sample_per_cell * wanted, SAMPLE_BYTES // (8 * (longest or 1))))
    radius = float(radius or 0.0)
    if n:
        # Different vectors by a share of their hashes: about ``most``, however many copies.
        low = F.shiftrightunsigned(h, 11) / F.lit(float(1 << 53)) < min(1.0, most / max(distinct, 1))
        sample = good.filter(low).select("vector").distinct().orderBy(h, "vector").toArrow()
        if not sample.num_rows:
            sample = good.select("vector").limit(1).toArrow()
        # Batch by batch, so that the driver holds the points and no second copy of them.
        points = np.concatenate(
            [as_points(matrix(b.column(0)), metric, "right", radius) for b in sample.to_batches(DRIVER_ROWS) if b.num_rows]
        )
        del sample
        centres = kmeans(points, wanted, seed=seed)
        del points
        # Which cell is full is known only after all rows are placed, so they are written twice.
        placed = materialise(_place(good, centres, metric, radius), "placed")
        facts = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("_gap").alias("reach"))
        kept = {r["cell"]: (r["n"], r["reach"]) for r in facts.collect()}  # at most 4,096 rows
    else:
        placed = good.withColumns({"cell": F.lit(0), "_gap": F.lit(0.0)})
        centres, kept = np.zeros((0, 0)), {}
    parts = {cell: -(-size // file_rows) for cell, (size, _) in kept.items()}
    counts = [spark.createDataFrame(sorted(parts.items()), "cell int, _parts int")]
    total = max(1, sum(parts.values()))
    (
        placed.join(F.broadcast(counts[0]), "cell", "left")
        .repartition(total, "cell", F.pmod(F.xxhash64("id"), F.col("_parts")))
        .drop("_gap", "_parts")
        .sortWithinPartitions("cell")
        .write.mode("overwrite")
        .partitionBy("cell")
        .parquet(f"{target}/rows")
    )
    listed = [(c, centres[c].tolist(), *kept[c]) for c in sorted(kept)]
    for name, rows, kind in (
        ("cells", listed, "cell int, centre array<double>, n long, reach double"),
        ("settings", [(metric, radius, n)], SETTINGS),
    ):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("overwrite").parquet(f"{target}/{name}")
    schema = T.StructType([*good.schema.fields, T.StructField("cell", T.IntegerType())])
    spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(f"{target}/shape")
    return open_inverted_index(spark, target)


def open_inverted_index(spark: SparkSession, path: str) -> InvertedIndex:
    """An index that :func:`build_inverted_index` stored; nothing is computed."""
    metric, radius, n = spark.read.schema(SETTINGS).parquet(f"{path}/settings").first()
    cells = spark.read.schema("cell int, centre array<double>, n long, reach double").parquet(f"{path}/cells")
    schema = spark.read.parquet(f"{path}/shape").schema
    rows = spark.read.schema(schema).parquet(f"{path}/rows") if n else spark.createDataFrame([], schema)
    return InvertedIndex(rows, cells, metric, radius, n)


def _centres(index: InvertedIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, centres, sizes and reaches of the cells: at most 4,096."""
    table = index.cells.orderBy("cell").toArrow()
    return (
        table["cell"].to_numpy(),
        matrix(table["centre"]),
        table["n"].to_numpy(),
        table["reach"].to_numpy(),
    )


def _probed(
    points: np.ndarray, centres: np.ndarray, sizes: np.ndarray, reach: np.ndarray, k: int, probes: int | None
) -> np.ndarray:
    """Which cells each point visits: the nearest ``probes``, and more until they hold ``k`` rows.

    Without ``probes`` all cells that may hold one of the ``k`` nearest, by the triangle
    inequality: none whose nearest possible row is farther than ``k`` rows surely are.
    """
    gaps = distances(points, centres)
    line = np.arange(len(gaps))
    if probes is None:
        upper = gaps + reach
        order = upper.argsort(axis=1, kind="stable")
        covered = np.cumsum(sizes[order], axis=1)
        last = np.where(covered[:, -1] >= k, (covered >= k).argmax(axis=1), len(centres) - 1)
        return gaps - reach <= upper[line, order[line, last]][:, None] + 1e-6
    order = gaps.argsort(axis=1, kind="stable")
    before = np.cumsum(sizes[order], axis=1) - sizes[order]
    chosen = (np.arange(len(centres)) < probes) | (before < k)
    visit = np.zeros(gaps.shape, bool)
    np.put_along_axis(visit, order, chosen, axis=1)
    return visit


def query_inverted(
    index: InvertedIndex,
    query: list[float],
    k: int = 5,
    *,
    columns: list[str],
    probes: int | None = 8,
) -> DataFrame:
    """The ``k`` stored rows nearest to one vector: ``columns`` and ``distance``.

    Only the partitions of the nearest ``probes`` cells are read, and of more cells if these
    hold fewer than ``k`` rows. ``probes=None`` reads all cells that may hold a neighbour and
    is exact. Equal distances are ordered by id.
    """
    chosen: list[int] = []
    if index.n:
        numbers, centres, sizes, reach = _centres(index)
        point = as_points(np.asarray([query], dtype=np.float64), index.metric, "left", index.radius)
        if index.metric == "dot":  # the query's place on the sphere does not change the order
            point = point * index.radius
        chosen = numbers[_probed(point, centres, sizes, reach, k, probes)[0]].tolist()
    scored = index.rows.filter(F.col("cell").isin(chosen)).select(
        *dict.fromkeys([*columns, "id"]),
        (1 - score_to(F.col("vector"), query, index.metric)).alias("distance"),
    )
    return scored.orderBy("distance", "id").limit(k).select(*columns, "distance")


def inverted_topk(
    left: DataFrame,
    index: InvertedIndex,
    k: int = 3,
    *,
    left_id: str = "id",
    vector: str = "vector",
    probes: int | None = 8,
    exclude_self: bool = False,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Up to ``k`` near rows of the index for each left row: ``source_id, target_id, score, rank``.

    Each left row visits its nearest ``probes`` cells (all that may hold a neighbour without
    it). Only visited cells are read; large ones are cut into chunks and the left rows that
    meet in a chunk into splits, so a task holds about ``group_rows`` of either side. Scores
    are exact.
    """
    keep = k + exclude_self
    lhs = left.filter(vector_ok(F.col(vector))).select(
        F.col(left_id).alias("source_id"), F.col(vector).alias("_vec")
    )
    rhs = index.rows.select(F.col("id").alias("target_id"), F.col("vector").alias("_vec"), "cell")
    numbers, centres, sizes, reach = _centres(index)
    chunks = -(-sizes // group_rows)
    shared = left.sparkSession.sparkContext.broadcast((numbers, centres, sizes, reach, chunks))
    schema = T.StructType(
        [
            *lhs.schema.fields,
            T.StructField("_cells", T.ArrayType(T.IntegerType())),
            T.StructField("_chunks", T.ArrayType(T.LongType())),
        ]
    )
    metric, radius, n = index.metric, index.radius, index.n

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, centres, sizes, reach, chunks = shared.value
        step = max(1, DISTANCE_CELLS // max(1, len(numbers)))
        for batch in (b.slice(at, step) for b in batches for at in range(0, b.num_rows, step)):
            if not n:
                continue
            points = as_points(matrix(batch.column(1)), metric, "left", radius)
            if metric == "dot":
                points = points * radius
            where = _probed(points, centres, sizes, reach, keep, probes)
            ends = pa.array(np.concatenate([[0], np.cumsum(where.sum(axis=1))]).astype(np.int32))
            found = np.nonzero(where)[1]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.ListArray.from_arrays(ends, pa.array(numbers[found].astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(chunks[found].astype(np.int64))),
                ],
                names=schema.names,
            )

    probed = materialise(lhs.mapInArrow(visit, schema), "probes")
    met = probed.select("source_id", "_vec", F.explode(F.arrays_zip("_cells", "_chunks")).alias("_to"))
    visits = met.select(
        "source_id",
        "_vec",
        F.col("_to._cells").alias("cell"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_to._chunks") - 1)).alias("_chunk"),
    )
    # At most 4,096 cells: their numbers prune the partitions that are read.
    seen = [r[0] for r in visits.select("cell").distinct().collect()]
    facts = left.sparkSession.createDataFrame(
        [(int(c), int(m)) for c, m in zip(numbers, chunks)], "cell int, _of long"
    )
    rights = (
        rhs.filter(F.col("cell").isin(seen))
        .join(F.broadcast(facts), "cell")
        .withColumn("_chunk", F.pmod(F.xxhash64("target_id"), F.col("_of")))
    )
    found = score_groups(visits, rights, ["cell", "_chunk"], keep, metric, group_rows)
    if exclude_self:
        found = found.filter(F.col("source_id") != F.col("target_id"))
    return top_k_per_group(found, ["source_id"], [F.col("score").desc(), "target_id"], k)
