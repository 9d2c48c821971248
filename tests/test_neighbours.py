"""Exact and approximate neighbours against brute force."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinweave.functions.vectors import nearest, prepare
from kinweave.operators import neighbours as neighbour_module
from kinweave.operators.approximate import approximate_topk, build_vector_index
from kinweave.operators.embed import embed, embed_rows, hashed_ngrams, ngram_vectors
from kinweave.operators.neighbours import query_index, topk_similarity

DATA = "/root/testdata/sf0.001/embeddings.parquet"


def frame(spark, rows, block=None):
    data = [(i, [float(x) for x in r], block[i] if block else "a") for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "id long, vector array<double>, block string")


def brute(left, right, k, metric="cosine", same=False, blocks=None):
    """All pairs, scored one by one."""
    out = {}
    for i, a in enumerate(left):
        scored = []
        for j, b in enumerate(right):
            if (same and i == j) or (blocks and blocks[0][i] != blocks[1][j]):
                continue
            if metric == "cosine":
                size = np.linalg.norm(a) * np.linalg.norm(b)
                score = a @ b / size if size else 0.0
            elif metric == "l2":
                score = 1 - np.linalg.norm(a - b)
            else:
                score = a @ b
            scored.append((-round(float(score), 9), j))
        out[i] = [j for _, j in sorted(scored)[:k]]
    return out


def neighbours(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        got.setdefault(r.source_id, []).append(r.target_id)
    return got


def sample(n, dim, seed, clusters=0):
    rng = np.random.default_rng(seed)
    rows = rng.standard_normal((n, dim))
    if clusters:
        centres = rng.standard_normal((clusters, dim)) * 10
        rows = centres[rng.integers(0, clusters, n)] + rows * 0.3
    return rows.round(3)


FORMS = {"small": {}, "partitioned": dict(small_rows=0, group_rows=20, pivots=5)}


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("metric", ["cosine", "l2", "dot"])
def test_exact_equals_brute_force(spark, form, metric):
    left, right = sample(40, 8, 1, 4), sample(120, 8, 2, 6)
    left[3] = 0  # a zero vector is a row like others
    right[7] = 0
    got = topk_similarity(frame(spark, left), frame(spark, right), 3, metric=metric, **FORMS[form])
    want = brute(left, right, 3, metric)
    assert neighbours(got) == want


@pytest.mark.parametrize("form", FORMS)
def test_copies_of_one_vector(spark, form):
    """A third of each side is one vector: all of it is answered, ties by id."""
    left, right = sample(30, 6, 3), sample(90, 6, 4)
    left[::3] = left[0]
    right[::3] = left[0]
    got = topk_similarity(frame(spark, left), frame(spark, right), 4, **FORMS[form])
    assert neighbours(got) == brute(left, right, 4)
    got = topk_similarity(frame(spark, right), frame(spark, right), 4, exclude_self=True, **FORMS[form])
    assert neighbours(got) == brute(right, right, 4, same=True)


@pytest.mark.parametrize("form", FORMS)
def test_blocks(spark, form):
    left, right = sample(30, 6, 5), sample(60, 6, 6)
    lb, rb = ["abx"[i % 3] for i in range(30)], ["ab"[i % 2] if i > 1 else None for i in range(60)]
    got = topk_similarity(
        frame(spark, left, lb), frame(spark, right, rb), 3, block=["block"], **FORMS[form]
    )
    want = {i: t for i, t in brute(left, right, 3, blocks=(lb, rb)).items() if t}
    assert neighbours(got) == want


def test_fewer_rows_than_k_and_empty_sides(spark):
    rows = frame(spark, sample(2, 4, 7))
    for form in FORMS.values():
        assert neighbours(topk_similarity(rows, rows, 5, **form)) == brute(*[sample(2, 4, 7)] * 2, 5)
    assert topk_similarity(rows, rows.limit(0), 3).count() == 0
    assert topk_similarity(rows.limit(0), rows, 3).count() == 0
    with pytest.raises(ValueError):
        topk_similarity(rows, rows, 3, metric="other")


@pytest.mark.parametrize("parts", [1, 7])
def test_result_does_not_depend_on_partitions_or_order(spark, parts):
    rows = spark.read.parquet(DATA).select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    want = {tuple(r) for r in topk_similarity(rows, rows, 3, exclude_self=True).collect()}
    mixed = rows.repartition(parts).orderBy(F.xxhash64("id"))
    for form in FORMS.values():
        got = {tuple(r) for r in topk_similarity(mixed, mixed, 3, exclude_self=True, **form).collect()}
        assert got == want


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    n=st.integers(1, 12), m=st.integers(1, 12), k=st.integers(1, 5), seed=st.integers(0, 99),
    cells=st.sampled_from([1, 10, 1000]),
)
def test_kernel(n, m, k, seed, cells):
    left, right = sample(n, 3, seed), sample(m, 3, seed + 1)
    right[: m // 2] = right[0]
    for metric in ("cosine", "l2", "dot"):
        li, ri, _ = nearest(prepare(left, metric), prepare(right, metric), k, metric, cells)
        got = {}
        for a, b in zip(li, ri):
            got.setdefault(int(a), []).append(int(b))
        assert got == brute(left, right, k, metric)


def test_single_query(spark):
    rows = sample(50, 5, 8)
    near = query_index(frame(spark, rows), list(rows[4]), 3, columns=["id", "block"]).collect()
    assert [r.id for r in near] == brute(rows[4:5], rows, 3)[0]
    assert near[0].distance == pytest.approx(0, abs=1e-9)


def planted(n=600, dim=32, seed=9):
    rng = np.random.default_rng(seed)
    right = rng.standard_normal((n, dim))
    left = right[rng.permutation(n)[:150]] + rng.standard_normal((150, dim)) * 0.1
    return left, right


def recall(got, want):
    return sum(len(set(got.get(i, [])) & set(t)) for i, t in want.items()) / sum(map(len, want.values()))


def test_approximate_finds_planted_rows_with_exact_scores(spark):
    left, right = planted()
    near = topk_similarity(frame(spark, left), frame(spark, right), 1)
    want = neighbours(near)
    scores = {(r.source_id, r.target_id): r.score for r in near.collect()}
    index = build_vector_index(frame(spark, right), tables=8, block_rows=64)
    found = approximate_topk(frame(spark, left), index, 3)
    assert recall({i: t[:1] for i, t in neighbours(found).items()}, want) >= 0.9
    for r in found.collect():
        if (r.source_id, r.target_id) in scores:
            assert r.score == scores[r.source_id, r.target_id]


def test_more_tables_never_lower_recall(spark):
    rows = spark.read.parquet(DATA).select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    want = neighbours(topk_similarity(rows, rows, 3, exclude_self=True))
    reached = []
    for tables in (1, 4, 12):
        index = build_vector_index(rows, tables=tables, block_rows=64)
        reached.append(recall(neighbours(approximate_topk(rows, index, 3, exclude_self=True)), want))
    assert reached == sorted(reached)


def test_approximate_with_one_hot_signature(spark):
    """Most rows are one vector; each query still gets its k, and parts do not matter."""
    rows = sample(300, 8, 10)
    rows[:200] = rows[0]
    df = frame(spark, rows)
    index = build_vector_index(df, tables=4, block_rows=32)
    one = approximate_topk(df, index, 3)
    got = neighbours(one)
    assert all(len(got[i]) == 3 for i in range(300))
    assert all(set(got[i]) <= set(range(200)) for i in range(200))
    again = approximate_topk(df.repartition(11), index, 3)
    assert {tuple(r) for r in one.collect()} == {tuple(r) for r in again.collect()}
    met = approximate_topk(df, index, 3, small_rows=0)
    assert {tuple(r) for r in one.collect()} == {tuple(r) for r in met.collect()}


def test_index_can_be_stored(spark, tmp_path):
    df = frame(spark, sample(20, 4, 11))
    index = build_vector_index(df, tables=2, path=str(tmp_path / "index"))
    assert approximate_topk(df, index, 1).count() == 20
    with pytest.raises(ValueError):
        build_vector_index(df, bits=63)


TEXTS = ["john bardeen physics 1956", "john bardeen physics 1972", "é😀x", "a", "", None, "a"]


def test_embed_sees_each_text_once(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")
    calls = spark.sparkContext.accumulator(0)

    def model(texts):
        calls.add(len(texts))
        return hashed_ngrams(texts)

    rows = embed(df, "t", model).orderBy("id").collect()
    assert calls.value == len({t for t in TEXTS if t is not None})
    assert [r.vector is None for r in rows] == [t is None for t in TEXTS]
    assert rows[3].vector == rows[6].vector
    assert np.linalg.norm(rows[0].vector) == pytest.approx(1, abs=1e-6)
    assert not np.any(rows[4].vector)
    plain = {r.id: r.vector for r in embed_rows(df, "id", "t", batch_rows=2).collect()}
    assert all(plain[r.id] == r.vector for r in rows if r.vector is not None)


def test_column_counts_equal_the_default_model(spark):
    texts = [t for t in TEXTS if t] + ["line\nbreak  twice", "x" * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    counts = {r.id: np.array(r.vector) for r in ngram_vectors(df, "id", "t").collect()}
    want = hashed_ngrams(texts)
    for i, counted in counts.items():
        assert np.allclose(counted / np.linalg.norm(counted), want[i])
    assert len(counts) == len(texts)


def test_a_row_is_sent_once_to_a_group_of_cells(spark, monkeypatch):
    """In vectors without clusters no cell is ruled out; the visits grow with the groups, not the cells."""
    rows, seen = sample(300, 16, 12), []
    plain = neighbour_module.score_groups

    def counted(visits, rights, keys, *rest):
        seen.append((visits.count(), rights.groupBy(*keys).count().agg(F.max("count")).first()[0]))
        return plain(visits, rights, keys, *rest)

    monkeypatch.setattr(neighbour_module, "score_groups", counted)
    df = frame(spark, rows)
    got = topk_similarity(df, df, 3, exclude_self=True, small_rows=0, group_rows=100, pivots=40)
    assert neighbours(got) == brute(rows, rows, 3, same=True)
    # 40 cells of about 7 rows make four groups at most, of 100 rows at most.
    assert seen[0][0] <= 300 * 5 and seen[0][1] <= 100


def test_cells_are_packed_whole_or_dealt_out():
    first, chunks = neighbour_module._packed(np.array([3, 4, 5, 25, 1, 10, 2]), 10)
    assert first.tolist() == [0, 0, 1, 2, 5, 6, 7]
    assert chunks.tolist() == [1, 1, 1, 3, 1, 1, 1]


def test_names_are_dealt_to_tasks_before_they_are_embedded(spark):
    """One file is one task, however many names it holds."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, t string").coalesce(1)
    dealt = embed_rows(df, "id", "t", partitions=3)
    assert dealt.rdd.getNumPartitions() == 3
    assert {r.id: r.vector for r in dealt.collect()} == {r.id: r.vector for r in embed_rows(df, "id", "t").collect()}


def test_groups_are_scored_in_tasks_of_their_own_number(spark):
    """Groups of few bytes are not put together into one task: their scores are the work."""
    rows = np.eye(8)
    blocks = [f"b{i % 4}" for i in range(8)]
    left = frame(spark, rows, blocks).toDF("source_id", "_vec", "_block")
    right = frame(spark, rows, blocks).toDF("target_id", "_vec", "_block")
    found = neighbour_module.score_groups(left, right, ["_block"], 2, "cosine", 100)
    assert found.rdd.getNumPartitions() == 8
    assert found.count() == 16


def test_small_groups_share_a_task(spark, monkeypatch):
    """The blocks of an index are small, so a task scores as many as have the rows of a large group."""
    rows = np.eye(8)
    blocks = [f"b{i % 4}" for i in range(8)]
    left = frame(spark, rows, blocks).toDF("source_id", "_vec", "_block")
    right = frame(spark, rows, blocks).toDF("target_id", "_vec", "_block")
    plain, seen = neighbour_module.score_groups, []
    found = plain(left, right, ["_block"], 2, "cosine", 100, 4)
    assert found.rdd.getNumPartitions() == 2
    assert sorted(found.collect()) == sorted(plain(left, right, ["_block"], 2, "cosine", 100).collect())

    def counted(*args):
        seen.append(args[6])
        return plain(*args)

    monkeypatch.setattr("kinweave.operators.approximate.score_groups", counted)
    df = frame(spark, sample(60, 4, 3))
    index = build_vector_index(df, tables=2, block_rows=6)
    assert approximate_topk(df, index, 1, small_rows=0, group_rows=30).count() == 60
    assert seen == [5]
