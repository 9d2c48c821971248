"""Exact top-k search by inner product: a Voronoi kNN join with bounds from group summaries."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.session import materialise

SCALE = 256
TOP = 5
# Cells of queries around pivots, at most; few queries make few cells.
MOST_PIVOTS = 256
QUERIES_PER_PIVOT = 64
# Rows of either side that one task solves at a time.
CELL_QUERIES, CELL_ROWS = 2048, 8192
# Whole numbers up to here are exact in a double.
EXACT = 1 << 53
LONG = np.iinfo(np.int64)


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, vec): every component x as floor(scale * x); rows without a proper vector are out.

    Out are NULL ids, NULL vectors and vectors with a NULL, NaN or infinite component. Shorter
    vectors are filled up with zeros; rows that repeat an id and a vector are one.
    """
    v = F.transform(vector_col, lambda x: x.cast("double"))
    bad = F.exists(
        v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    whole = (
        vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~bad)
        .select(
            F.col(id_col).cast("long").alias("id"),
            F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("vec"),
        )
    )
    dim = whole.agg(F.max(F.size("vec"))).first()[0] or 1
    fill = F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("vec"))
    return whole.withColumn("vec", F.concat("vec", fill)).distinct()


def _matrix(column: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel()))


def _nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivot of each row and the distance to it, a little too large if at all."""
    square = (pivots**2).sum(axis=1)
    group = (square - 2 * (x @ pivots.T)).argmin(axis=1)
    return group, np.sqrt(((x - pivots[group]) ** 2).sum(axis=1)) * (1 + 1e-9)


def _spread(ids: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A pseudorandom number in [0, n) from each id."""
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % n.astype(np.uint64)).astype(np.int64)


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products; those beyond a long are cut to its range."""
    most = int(np.abs(q.astype(np.float64)).max()) * int(np.abs(x.astype(np.float64)).max())
    if most * q.shape[1] < EXACT:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    whole = q.astype(object) @ x.T.astype(object)
    return np.clip(whole, LONG.min, LONG.max).astype(np.int64)


def _best(q_ids, q, x_ids, x, k: int):
    """(query row, data row, score) of the k best of each query, ties to smaller ids."""
    order = np.argsort(x_ids, kind="stable")
    x_ids, x = x_ids[order], x[order]
    scores = _scores(q, x)
    for row, (own, line) in enumerate(zip(q_ids, scores)):
        others = np.flatnonzero(x_ids != own)
        if len(others) > k:
            cut = np.partition(line[others], len(others) - k)[len(others) - k]
            others = others[line[others] >= cut]
        for at in others[np.argsort(-line[others].astype(object), kind="stable")][:k]:
            yield row, x_ids[at], line[at]


def _per_id(ids: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each id once, with the best of its rows in every column."""
    order = np.argsort(ids, kind="stable")
    ordered = ids[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    if len(first) == len(ids):
        return ids, low
    return ordered[first], np.maximum.reduceat(low[order], first, axis=0)


def _top_ids(top, top_ids, low, ids, n: int) -> tuple[np.ndarray, np.ndarray]:
    """In every column the ``n`` best values of different ids, from two sets that each have an id once."""
    if len(low) > n:
        at = np.argpartition(low, len(low) - n, axis=0)[-n:]
        low, ids = np.take_along_axis(low, at, axis=0), ids[at]
    else:
        ids = np.broadcast_to(ids[:, None], low.shape)
    values, names = np.concatenate([top, low]), np.concatenate([top_ids, ids])
    order = np.argsort(-values, axis=0, kind="stable")
    values, names = (np.take_along_axis(v, order, axis=0) for v in (values, names))
    for i in range(1, len(values)):
        values[i, (names[:i] == names[i]).any(axis=0)] = -np.inf
    order = np.argsort(-values, axis=0, kind="stable")[:n]
    return np.take_along_axis(values, order, axis=0), np.take_along_axis(names, order, axis=0)


def _grouped(pivots: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Cells with queries, put together with their nearest until a group fills a cell's rows.

    A row goes once to a group that needs it, however many of its cells do.
    """
    left, groups = set(np.flatnonzero(sizes).tolist()), []
    while left:
        start = min(left)
        near = ((pivots - pivots[start]) ** 2).sum(axis=1)
        taken, size = [], 0
        for cell in sorted(left, key=lambda c: (near[c], c)):
            if taken and size + sizes[cell] > CELL_QUERIES:
                break
            taken.append(cell)
            size += sizes[cell]
        left -= set(taken)
        groups.append(np.array(taken))
    return groups


def _pivots(queries: DataFrame, most: int, per_pivot: int) -> np.ndarray:
    """A bounded sample of the distinct queries, in the order of a hash; at most ``most``."""
    n = queries.count()
    wanted = min(most, max(1, math.ceil(n / per_pivot)))
    rows = queries.select("vec").distinct().orderBy(F.xxhash64("vec"), "vec").limit(wanted).collect()
    return np.array([r[0] for r in rows], dtype=np.float64)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = TOP,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
    most_pivots: int = MOST_PIVOTS,
    per_pivot: int = QUERIES_PER_PIVOT,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its ``k`` best other rows.

    Rows where ``is_query`` (over the input's columns) holds are the queries; candidates are
    all rows but those with the query's id. Ties go to the smaller id. Improper vectors take
    no part (see ``quantised``); a query without any other row has no result; other columns
    are left out; an empty input gives no rows.

    Queries and data fall into cells around their nearest pivots. A cell of queries is a ball,
    so the products with a row lie within the ball's radius times the row's length of the
    pivot's product. The (k + 1)-th best of the lower bounds, of the best one of each id, is
    what any query of the cell surely reaches, as one id at most is its own; rows, and cells of rows by their summary, whose upper bound stays below
    are not sent to it. Neighbouring cells make groups, and what a group is sent is solved in
    parts of bounded size. On vectors without any structure nothing can be ruled out.
    """
    rows = quantised(vectors, id_col, vector_col, scale)
    asked = quantised(vectors.filter(is_query), id_col, vector_col, scale)
    asked = materialise(asked, "topk-queries")
    # Beyond the k + 1 smallest ids, copies of a vector cannot be among the best.
    copies = Window.partitionBy("vec").orderBy("id")
    data = materialise(
        rows.withColumn("_nth", F.row_number().over(copies))
        .filter(F.col("_nth") <= k + 1)
        .select("id", "vec"),
        "topk-data",
    )
    out = "query_id long, rank int, vec_id long, score long"
    pivots = _pivots(asked, most_pivots, per_pivot)
    if not len(pivots):
        return vectors.sparkSession.createDataFrame([], out)
    width = max(pivots.shape[1], len(data.first()["vec"]))
    pivots = np.pad(pivots, ((0, 0), (0, width - pivots.shape[1])))
    n_groups = len(pivots)
    lengths = np.linalg.norm(pivots, axis=1)

    def filled(batch: pa.RecordBatch) -> np.ndarray:
        x = _matrix(batch.column(1), batch.num_rows)
        return np.pad(x, ((0, 0), (0, width - x.shape[1])))

    def of_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                group, away = _nearest(filled(batch).astype(np.float64), pivots)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group), pa.array(away)], names=["g", "away"]
                )

    balls = (
        asked.mapInArrow(of_queries, "g long, away double")
        .groupBy("g")
        .agg(F.max("away"), F.count(F.lit(1)))
        .collect()  # one row per pivot
    )
    radius, asked_in = np.zeros(n_groups), np.zeros(n_groups, dtype=np.int64)
    for g, away, n in balls:
        radius[g], asked_in[g] = away, n
    live = asked_in > 0
    groups = _grouped(pivots, asked_in)
    group_of = np.zeros(n_groups, dtype=np.int64)
    for g, cells in enumerate(groups):
        group_of[cells] = g
    asked_by = np.array([asked_in[cells].sum() for cells in groups], dtype=np.int64)

    def bounds(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        product, norm = x @ pivots.T, np.linalg.norm(x, axis=1)
        slack = norm[:, None] * radius + 1e-9 * norm[:, None] * (lengths + 1) + 1e-6
        return product - slack, product + slack

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per task: the k + 1 best lower bounds of different ids of each query group, and per
        data group its radius and greatest length."""
        top, top_ids = np.zeros((0, n_groups)), np.zeros((0, n_groups), dtype=np.int64)
        reach, norms = np.full(n_groups, -1.0), np.zeros(n_groups)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = filled(batch).astype(np.float64)
            ids, low = _per_id(batch.column(0).to_numpy(), bounds(x)[0])
            top, top_ids = _top_ids(top, top_ids, low, ids, k + 1)
            group, away = _nearest(x, pivots)
            np.maximum.at(reach, group, away)
            np.maximum.at(norms, group, np.linalg.norm(x, axis=1))
        rank, g = np.nonzero(top > -np.inf)
        met = np.flatnonzero(reach >= 0)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([g, met])),
                pa.array(np.concatenate([top_ids[rank, g], np.zeros(len(met), dtype=np.int64)])),
                pa.array(np.concatenate([top[rank, g], np.full(len(met), np.nan)])),
                pa.array(np.concatenate([np.zeros(len(g)), reach[met]])),
                pa.array(np.concatenate([np.zeros(len(g)), norms[met]])),
            ],
            names=["g", "id", "low", "reach", "norm"],
        )

    summary = materialise(
        data.mapInArrow(summaries, "g long, id long, low double, reach double, norm double"),
        "topk-summaries",
    )
    best_low = Window.partitionBy("g").orderBy(F.desc("low"))
    sure = (
        summary.filter(~F.isnan("low"))
        .groupBy("g", "id")
        .agg(F.max("low").alias("low"))
        .withColumn("_nth", F.row_number().over(best_low))
        .filter(F.col("_nth") == k + 1)
        .select("g", "low")
        .collect()  # one row per pivot
    )
    floor = np.full(n_groups, -np.inf)
    for g, low in sure:
        floor[g] = low
    reach, norms = np.full(n_groups, -1.0), np.zeros(n_groups)
    for g, far, norm in (
        summary.filter(F.isnan("low")).groupBy("g").agg(F.max("reach"), F.max("norm")).collect()
    ):
        reach[g], norms[g] = far, norm
    # Data group j against query group i: no row of j can reach what i surely has.
    greatest = pivots @ pivots.T + np.outer(reach, lengths) + np.outer(norms, radius)
    greatest += 1e-9 * np.outer(norms + 1, lengths + 1) + 1e-6
    open_pairs = (greatest >= floor) & live

    def needed(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, group of cells) of all rows that may be among the best of a cell in it."""
        cell, _ = _nearest(x, pivots)
        wanted = open_pairs[cell] & (bounds(x)[1] >= floor)
        return np.nonzero(np.stack([wanted[:, cells].any(axis=1) for cells in groups], axis=1))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(groups), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                sent = needed(filled(batch).astype(np.float64))[1]
                count += np.bincount(sent, minlength=len(groups))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(groups))), pa.array(count)], names=["g", "n"]
        )

    sent_to = np.zeros(len(groups), dtype=np.int64)
    for g, n in data.mapInArrow(sizes, "g long, n long").groupBy("g").agg(F.sum("n")).collect():
        sent_to[g] = n
    q_cells = np.maximum(1, -(-asked_by // CELL_QUERIES))
    x_cells = np.maximum(1, -(-sent_to // CELL_ROWS))
    schema = "g long, s long, c long, id long, vec array<long>"

    def dealt(x, ids, row, group, own: np.ndarray, other: np.ndarray, own_first: bool):
        """Rows with their own chunk, once for each chunk of the other side."""
        chunk = _spread(ids[row], own[group])
        times = other[group]
        row, group, chunk = (np.repeat(v, times) for v in (row, group, chunk))
        first = np.cumsum(times) - times
        across = np.arange(len(row)) - np.repeat(first, times)
        s, c = (chunk, across) if own_first else (across, chunk)
        for at in range(0, len(row), CELL_ROWS):
            part = slice(at, at + CELL_ROWS)
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(v[part]) for v in (group, s, c)),
                    pa.array(ids[row[part]]),
                    _lists(x[row[part]]),
                ],
                names=["g", "s", "c", "id", "vec"],
            )

    def deal_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = filled(batch)
                group = group_of[_nearest(x.astype(np.float64), pivots)[0]]
                yield from dealt(
                    x, batch.column(0).to_numpy(), np.arange(len(x)), group, q_cells, x_cells, True
                )

    def deal_data(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = filled(batch)
                row, group = needed(x.astype(np.float64))
                yield from dealt(
                    x, batch.column(0).to_numpy(), row, group, x_cells, q_cells, False
                )

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            q_ids, q = left["id"].to_numpy(), _matrix(left["vec"], left.num_rows)
            x_ids, x = right["id"].to_numpy(), _matrix(right["vec"], right.num_rows)
            codes = left["code"].to_numpy()
            found = [
                (q_ids[row], codes[row], vec_id, score)
                for row, vec_id, score in _best(q_ids, q, x_ids, x, k)
            ]
        columns = zip(*found) if found else [[]] * 4
        return pa.table(
            [pa.array(np.array(list(c), dtype=np.int64)) for c in columns],
            names=["query_id", "code", "vec_id", "score"],
        )

    cell = ["g", "s", "c"]
    left = asked.mapInArrow(deal_queries, schema).withColumn("code", F.xxhash64("vec"))
    right = data.mapInArrow(deal_data, schema)
    local = (
        left.groupBy(*cell)
        .cogroup(right.groupBy(*cell))
        .applyInArrow(solve, "query_id long, code long, vec_id long, score long")
    )
    # ``code`` keeps apart queries with one id and several vectors.
    order = Window.partitionBy("query_id", "code").orderBy(F.desc("score"), "vec_id")
    return (
        local.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
