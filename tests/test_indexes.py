"""Stored indexes: what they read, what they find, and that opening one computes nothing."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinweave.operators.approximate import approximate_topk, build_vector_index, open_vector_index
from kinweave.operators.inverted import (
    build_inverted_index,
    inverted_topk,
    kmeans,
    open_inverted_index,
    query_inverted,
)
from kinweave.operators.neighbours import topk_similarity
from tests.test_neighbours import brute, frame, neighbours, planted, recall, sample

METRICS = ["cosine", "l2", "dot"]


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_read(df):
    """Files that the scan of an executed frame opened, by its own counter."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return sum(s.metrics().apply("numFiles").value() for s in scans if s.nodeName().startswith("Scan"))


@pytest.fixture(scope="module")
def clustered():
    return sample(1500, 8, 21, clusters=30)


@pytest.mark.parametrize("metric", METRICS)
def test_single_query_reads_few_files_and_finds_the_nearest(spark, clustered, metric):
    index = build_inverted_index(frame(spark, clustered), metric=metric, payload=["block"])
    files = len(index.rows.inputFiles())
    want = brute(clustered[:40], clustered, 5, metric)
    hits = 0
    for i in range(20):
        near = query_inverted(index, list(clustered[i]), 5, columns=["id", "block"], probes=3)
        got = near.collect()
        assert 0 < files_read(near) < 0.25 * files
        hits += len({r.id for r in got} & set(want[i]))
        exact = query_inverted(index, list(clustered[i]), 5, columns=["id"], probes=None)
        assert [r.id for r in exact.collect()] == want[i]
    assert hits >= 0.9 * 5 * 20


@pytest.mark.parametrize("metric", METRICS)
def test_batch_through_cells(spark, clustered, metric):
    index = build_inverted_index(frame(spark, clustered), metric=metric, file_rows=20)
    left = clustered[::5] + 0.01
    want = brute(left, clustered, 3, metric)
    near = inverted_topk(frame(spark, left), index, 3, probes=4, group_rows=16)
    assert recall(neighbours(near), want) >= 0.9
    whole = inverted_topk(frame(spark, left), index, 3, probes=None, group_rows=16)
    assert neighbours(whole) == want
    scores = {(r.source_id, r.target_id): r.score for r in whole.collect()}
    assert all(scores.get((r.source_id, r.target_id), r.score) == r.score for r in near.collect())
    same = inverted_topk(frame(spark, clustered).repartition(7), index, 2, probes=None, exclude_self=True)
    assert neighbours(same) == brute(clustered, clustered, 2, metric, same=True)


def test_cells_of_copies_and_odd_rows(spark, tmp_path):
    rows = sample(200, 4, 22)
    rows[:120] = rows[0]
    df = frame(spark, rows)
    bad = spark.createDataFrame(
        [(900, None, "a"), (901, [float("nan")] * 4, "a"), (902, [1.0, None, 1.0, 1.0], "a"), (903, [1.0], "a")],
        df.schema,
    )
    index = build_inverted_index(df.unionByName(bad), dim=4, file_rows=16, path=str(tmp_path / "i"))
    assert index.n == 200
    again = open_inverted_index(spark, str(tmp_path / "i"))
    # A hot cell is several files.
    sizes = [r["count"] for r in again.rows.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 200 and max(sizes) < 100
    near = query_inverted(again, list(rows[0]), 130, columns=["id"], probes=1).collect()
    assert len(near) == 130 and [r.id for r in near[:120]] == list(range(120))
    empty = build_inverted_index(df.limit(0))
    assert query_inverted(empty, [1.0] * 4, 3, columns=["id"]).count() == 0
    assert inverted_topk(df, empty, 3).count() == 0
    assert inverted_topk(df.limit(0), again, 3).count() == 0
    with pytest.raises(ValueError):
        build_inverted_index(df, metric="other")


def test_kmeans_centres():
    rng = np.random.default_rng(3)
    points = np.repeat(rng.standard_normal((5, 3)) * 10, 20, axis=0)
    centres = kmeans(points, 5)
    assert {tuple(c) for c in centres.round(6)} == {tuple(p) for p in points.round(6)}
    assert len(kmeans(points, 50)) == 5  # no more cells than different points
    assert len(kmeans(points[:1], 4)) == 1


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("small", [0, 4096])
def test_approximate_recall_of_each_metric(spark, metric, small):
    left, right = planted()
    if metric == "dot":  # a planted row is the nearest only if it is long
        left, right = left, np.concatenate([right, 3 * left])
    index = build_vector_index(frame(spark, right), metric=metric, block_rows=64)
    found = approximate_topk(frame(spark, left), index, 3, small_rows=small)
    exact = topk_similarity(frame(spark, left), frame(spark, right), len(right), metric=metric)
    assert recall({i: t[:1] for i, t in neighbours(found).items()}, brute(left, right, 1, metric)) >= 0.9
    scores = {(r.source_id, r.target_id): r.score for r in exact.collect()}
    assert all(scores[r.source_id, r.target_id] == r.score for r in found.collect())


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_copies_are_always_found(spark, metric):
    """Equal vectors have equal signatures, also across the end of a block."""
    rows = sample(300, 6, 23)
    both = np.concatenate([rows, rows])
    index = build_vector_index(frame(spark, both), metric=metric, tables=1, block_rows=7)
    found = approximate_topk(frame(spark, rows), index, 20)
    got = neighbours(found)
    assert all(i in got[i] and i + 300 in got[i] for i in range(300))


def test_small_side_neither_sorts_nor_shuffles_the_index(spark):
    rows = sample(400, 8, 24)
    index = build_vector_index(frame(spark, rows), block_rows=32)
    plan = executed(approximate_topk(frame(spark, rows[:9]), index, 3))
    # Below the scoring there are scans and broadcasts alone; what comes after are results.
    below = plan[plan.index("MapInArrow"):]
    assert "FileScan parquet" in below
    assert not re.search(r"(?<!Broadcast)Exchange|Sort\\b|SortMergeJoin", below)
    assert below.count("BroadcastHashJoin") == 2


def test_bounds_stay_bounded_and_opening_keeps_them(spark, tmp_path, monkeypatch):
    from kinweave.operators import approximate

    monkeypatch.setattr(approximate, "MOST_BLOCKS", 40)
    rows = sample(500, 6, 25)
    path = str(tmp_path / "index")
    index = build_vector_index(frame(spark, rows), tables=4, block_rows=2, path=path, metric="l2")
    again = open_vector_index(spark, path)
    assert again.bounds.count() <= 40 and again.signer == index.signer
    assert again.entries.count() == 2000
    one = {tuple(r) for r in approximate_topk(frame(spark, rows), index, 2).collect()}
    assert one == {tuple(r) for r in approximate_topk(frame(spark, rows).repartition(5), again, 2).collect()}
    empty = build_vector_index(frame(spark, rows).limit(0))
    assert approximate_topk(frame(spark, rows), empty, 2).count() == 0
    assert approximate_topk(frame(spark, rows).limit(0), index, 2).count() == 0
