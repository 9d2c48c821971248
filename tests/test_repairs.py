"""Null orders, ids that are already there, improper vectors, stored indexes."""

import pytest
from pyspark.sql import functions as F

from kinweave.operators.approximate import approximate_topk, build_vector_index, open_vector_index
from kinweave.operators.keys import last_wins
from kinweave.operators.neighbours import query_index, topk_similarity
from kinweave.operators.nested import enrich_tree
from kinweave.operators.upsert import merge_edges, merge_nodes


def test_a_null_order_comes_first_and_keeps_its_values(spark):
    rows = spark.createDataFrame(
        [("a", "only", None), ("b", "early", None), ("b", "late", 1), ("c", None, 2), ("c", "x", None)],
        "k string, v string, o int",
    )
    assert dict(last_wins(rows, ["k"], ["v"], "o").collect()) == {"a": "only", "b": "late", "c": None}
    old = spark.createDataFrame([("a", "old")], "k string, v string")
    merged = merge_nodes(old, rows.filter("k = 'a'"), "k", ["v"], "o").table
    assert merged.collect() == [("a", "only")]
    nodes = spark.createDataFrame([("a",)], "id string")
    edges = rows.filter("k = 'a'").select(F.col("k").alias("src"), F.col("k").alias("dst"), "v", "o")
    assert merge_edges(None, edges, nodes, "id", nodes, "id", ["v"], "o").table.collect() == [
        ("a", "a", "only")
    ]


ITEM = "array<struct<name: string, type: string, id: string>>"


def test_ids_and_columns_of_the_tree_are_kept(spark):
    tree = spark.createDataFrame(
        [
            ("e1", [("x", "other", "x9"), ("l", "laureate", "old")], [("s", "scholar", "s7")], "more"),
            ("e2", [], None, None),
        ],
        f"entry string, children {ITEM}, parents {ITEM}, extra string",
    )
    lookup = spark.createDataFrame([("laureate", "l", "l1")], "type string, name string, id string")
    done = {r.entry: r for r in enrich_tree(tree, lookup, "entry").collect()}
    assert [c.id for c in done["e1"].children] == ["x9", "l1"]
    assert done["e1"].parents[0].id == "s7" and done["e1"].extra == "more"
    assert done["e2"].children == [] and done["e2"].parents is None and done["e2"].extra is None
    with pytest.raises(Exception, match="repeated entry id"):
        enrich_tree(tree.union(tree), lookup, "entry").collect()


def bad_vectors(spark):
    good = [(i, [float(i % 3) + 0.5, 1.0]) for i in range(12)]
    bad = [(20, [float("nan"), 1.0]), (21, [None, 1.0]), (22, [float("inf"), 1.0]), (23, None)]
    return spark.createDataFrame(good + bad, "id long, vector array<double>")


@pytest.mark.parametrize("metric", ["cosine", "l2", "dot"])
def test_improper_vectors_leave_both_forms_equal(spark, metric):
    rows = bad_vectors(spark)
    small = topk_similarity(rows, rows, 2, metric=metric)
    large = topk_similarity(rows, rows, 2, metric=metric, small_rows=0)
    assert sorted(small.collect()) == sorted(large.collect())
    assert {r.source_id for r in small.collect()} == set(range(12))
    with pytest.raises(Exception, match="improper vector"):
        topk_similarity(rows, rows, 2, metric=metric, bad="fail").collect()
    longer = rows.union(spark.createDataFrame([(30, [1.0, 2.0, 3.0])], rows.schema))
    assert sorted(topk_similarity(longer, longer, 2, metric=metric, dim=2).collect()) == sorted(small.collect())
    assert 20 not in {r.id for r in query_index(rows, [1.0, 1.0], 20, columns=["id"], metric=metric).collect()}


def test_a_stored_index_opens_with_its_settings(spark, tmp_path):
    rows = bad_vectors(spark)
    built = build_vector_index(rows, tables=3, bits=5, seed=9, path=str(tmp_path / "index"))
    opened = open_vector_index(spark, str(tmp_path / "index"))
    assert (opened.tables, opened.bits, opened.seed) == (3, 5, 9)
    found = [sorted(approximate_topk(rows, i, 1).collect()) for i in (built, opened)]
    assert found[0] == found[1] and len(found[0]) == 12
