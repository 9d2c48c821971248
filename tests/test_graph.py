"""Upserts, nested enrichment and path patterns."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinweave import schemas
from kinweave.operators.keys import key_collisions
from kinweave.operators.nested import enrich_tree
from kinweave.operators.paths import Graph, Hop, incoming_counts, match, reduced_edges
from kinweave.operators.upsert import merge_edges, merge_nodes, orphan_edges
from kinweave.sources.tables import DuplicateKeyError, GraphFolder
from tests.test_reshape import nested

NODE = "k string, a string, b string"


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_set_overwrites_with_null_and_keeps_other_columns(spark):
    old = spark.createDataFrame([("1", "a", "b"), ("2", "a", "b")], NODE)
    new = spark.createDataFrame([("1", None, 1), ("3", "n", 1), (None, "x", 1)], "k string, a string, o int")
    merged = merge_nodes(old, new, "k", ["a"], "o")
    assert as_set(merged.table) == {("1", None, "b"), ("2", "a", "b"), ("3", "n", None)}
    assert tuple(merged.counts.first()) == (2, 2)


def test_last_row_of_a_batch_wins(spark):
    new = spark.createDataFrame([("1", "x", 1), ("1", None, 3), ("1", "y", 2)], "k string, a string, o int")
    merged = merge_nodes(None, new, "k", ["a"], "o")
    assert as_set(merged.table) == {("1", None)}
    assert tuple(merged.counts.first()) == (3, 1)


rows = st.lists(
    st.tuples(st.sampled_from("123"), st.sampled_from(["x", "y", None]), st.integers(0, 3)), max_size=6
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(stored=st.dictionaries(st.sampled_from("1234"), st.sampled_from(["p", None])), batch=rows)
def test_merge_is_idempotent(spark, stored, batch):
    old = spark.createDataFrame([(k, v, "keep") for k, v in stored.items()], NODE)
    new = spark.createDataFrame(batch, "k string, a string, o int")
    once = merge_nodes(old, new, "k", ["a"], F.struct("o", "a")).table
    twice = merge_nodes(once, new, "k", ["a"], F.struct("o", "a")).table
    assert as_set(once) == as_set(twice)
    want = {k: (v, "keep") for k, v in stored.items()}
    for key, value, _ in sorted(batch, key=lambda r: (r[2], r[1] is not None, r[1] or "")):
        want[key] = (value, want.get(key, (None, None))[1])
    assert as_set(once) == {(k, *v) for k, v in want.items()}


def test_edges_need_both_ends(spark):
    nodes = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    new = spark.createDataFrame(
        [("a", "b", "1"), ("a", "b", "2"), ("a", "zz", "1"), ("zz", "b", "1"), (None, "b", "1")],
        "src string, dst string, p string",
    )
    merged = merge_edges(None, new, nodes, "id", nodes, "id", ["p"], "p")
    assert as_set(merged.table) == {("a", "b", "2")}
    assert tuple(merged.counts.first()) == (2, 1)
    orphans = as_set(orphan_edges(new, nodes, "id", nodes, "id"))
    assert orphans == {("a", "zz"), ("zz", "b"), (None, "b")}
    stored = spark.createDataFrame([("a", "b", "old"), ("b", "c", "old")], "src string, dst string, p string")
    again = merge_edges(stored, new, nodes, "id", nodes, "id", ["p"], "p").table
    assert as_set(again) == {("a", "b", "2"), ("b", "c", "old")}


LOOKUP = [("laureate", "X", "l1"), ("scholar", "X", "s9"), ("scholar", "P", "s1")]


def test_enrich_keeps_shape_and_order(spark):
    def ent(name, kind):
        return {"name": name, "type": kind, "category": None, "year": None}

    entries = [
        {"children": [ent("X", "laureate"), ent("X", "scholar"), ent("?", "laureate")], "parents": []},
        {"children": [ent("P", "other")]},
        {"parents": [ent("P", "scholar")] * 3, "children": []},
        {"children": [], "parents": []},
    ]
    tree = nested(spark, entries, schemas.TREE).withColumn("n", F.monotonically_increasing_id())
    lookup = spark.createDataFrame(LOOKUP, "type string, name string, id string")
    got = [
        (
            [e.id for e in r.children] if r.children is not None else None,
            [e.id for e in r.parents] if r.parents is not None else None,
        )
        for r in enrich_tree(tree.drop("n"), lookup).collect()
    ]
    want = [(["l1", "s9", None], []), ([None], None), ([], ["s1", "s1", "s1"]), ([], [])]
    assert sorted(got, key=str) == sorted(want, key=str)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    data=st.lists(
        st.tuples(*[st.lists(st.sampled_from(["X", "P", "?"]), max_size=4)] * 2), min_size=1, max_size=5
    )
)
def test_enrich_keeps_lengths(spark, data):
    def ents(names):
        return [{"name": n, "type": "scholar"} for n in names]

    entries = [{"children": ents(c), "parents": ents(p)} for c, p in data]
    tree = nested(spark, entries, schemas.TREE)
    lookup = spark.createDataFrame(LOOKUP, "type string, name string, id string")
    got = [([e.name for e in r.children], [e.name for e in r.parents]) for r in enrich_tree(tree, lookup).collect()]
    assert sorted(got) == sorted((list(c), list(p)) for c, p in data)


def test_collisions(spark):
    df = spark.createDataFrame([("A", "1"), ("A", "2"), ("B", "3")], "name string, id string")
    assert as_set(key_collisions(df, ["name"], "id")) == {("A", 2)}


def test_paths(spark):
    people = spark.createDataFrame(
        [("n", "Niels Bohr"), ("a", "Aage Bohr"), ("p", "P"), ("q", "Q"), ("r", "R")], "id string, fullName string"
    )
    edges = spark.createDataFrame([("p", "n"), ("q", "n"), ("r", "n"), ("n", "a")], "src string, dst string")
    graph = Graph({"S": people}, {"S": "id"}, {"M": edges}, {"M": ("S", "S")})
    counts = as_set(incoming_counts(graph, "M", "fullName", ["Bohr"], "n"))
    assert counts == {("Niels Bohr", 3), ("Aage Bohr", 1)}
    hops = [Hop("M", "m", "in"), Hop("M", "g", "in")]
    two = match(graph, "S", "s", hops, F.col("fullName").contains("Aage"))
    assert {(r.s_id, r.m_id, r.g_id) for r in two.collect()} == {("a", "n", x) for x in "pqr"}
    with pytest.raises(ValueError):
        match(Graph({"S": people, "T": people}, {"S": "id", "T": "id"}, {"M": edges}, {"M": ("S", "S")}), "T", "t", hops)


def random_graph(spark, seed, n=40):
    rng = random.Random(seed)
    labels = {"A": "id", "B": "name", "C": "id", "D": "id"}
    nodes = {
        label: spark.createDataFrame(
            [(f"{label}{i}", rng.randrange(5)) for i in range(n)], f"{key} string, kind int"
        )
        for label, key in labels.items()
    }
    ends = {"AB": ("A", "B"), "CB": ("C", "B"), "CD": ("C", "D")}
    edges = {}
    for name, (src, dst) in ends.items():
        rows = [(f"{src}{rng.randrange(n + 5)}", f"{dst}{rng.randrange(n + 5)}", rng.randrange(4)) for _ in range(90)]
        hub = [(f"{src}{i}", f"{dst}0", 1) for i in range(n)]  # one node has a third of the edges
        edges[name] = spark.createDataFrame(rows + hub, "src string, dst string, w int")
    return Graph(nodes, labels, edges, ends)


HOPS = [
    Hop("AB", "b", "out", "kind < 4", edge_where="w > 0"),
    Hop("CB", "c", "in", "kind <> 2", "cb", "w < 3"),
    Hop("CD", "d", "out", "kind IN (1, 2)"),
]


def plain_paths(graph, where, hops):
    def rows(df):
        return [r.asDict() for r in df.collect()]

    start = graph.nodes["A"].filter(where) if where else graph.nodes["A"]
    paths, label = [([n["id"]], []) for n in rows(start)], "A"
    for hop in hops:
        src, dst = graph.ends[hop.edge]
        near, far, label = ("src", "dst", dst) if hop.direction == "out" else ("dst", "src", src)
        edges = graph.edges[hop.edge]
        edges = edges if hop.edge_where is None else edges.filter(hop.edge_where)
        nodes = graph.nodes[label]
        nodes = nodes if hop.where is None else nodes.filter(hop.where)
        good = {n[graph.keys[label]] for n in rows(nodes)}
        paths = [
            (ids + [e[far]], ws + [e["w"]])
            for ids, ws in paths for e in rows(edges) if e[near] == ids[-1] and e[far] in good
        ]
    return sorted((*ids, *ws) for ids, ws in paths)


@pytest.mark.parametrize("seed, where", [(1, "kind = 3"), (2, None), (3, "kind = 99")])
def test_reduced_paths_equal_plain_ones(spark, seed, where):
    graph = random_graph(spark, seed)
    columns = ["a_id", "b_name", "c_id", "d_id", "ab_w", "cb_w", "cd_w"]
    want = plain_paths(graph, where, HOPS)
    for reduce in (False, True):
        found = match(graph, "A", "a", HOPS, where, reduce=reduce)
        assert sorted(map(tuple, found.select(*columns).collect())) == want
    assert {"a_kind", "b_kind", "c_kind", "d_kind"} <= set(match(graph, "A", "a", HOPS, where, reduce=True).columns)


def test_reduced_edges_are_those_of_the_answer(spark):
    graph = random_graph(spark, 1)
    kept = reduced_edges(graph, "A", HOPS, "kind = 3")
    want = plain_paths(graph, "kind = 3", HOPS)
    for i, part in enumerate(kept):
        assert {(r._near, r._far) for r in part.collect()} == {(p[i], p[i + 1]) for p in want}


def test_graph_folder(spark, tmp_path):
    folder = GraphFolder(spark, str(tmp_path))
    schema = spark.createDataFrame([], NODE).schema
    folder.declare_node("N", schema, "k")
    folder.declare_node("N", schema, "k")  # create if absent
    with pytest.raises(ValueError):
        folder.declare_edge("E", "N", "Missing")
    with pytest.raises(ValueError):
        folder.declare_node("Bad", schema, "nope")
    assert folder.table("N").count() == 0
    rows = spark.createDataFrame([("1", "b1", "a1")], "k string, b string, a string")
    folder.load_nodes(rows, "N")  # by name, not by position
    assert as_set(folder.table("N")) == {("1", "a1", "b1")}
    with pytest.raises(DuplicateKeyError):
        folder.load_nodes(rows, "N")
    with pytest.raises(DuplicateKeyError):
        folder.load_nodes(rows.withColumn("k", F.lit("2")).union(rows.withColumn("k", F.lit("2"))), "N")
    folder.load_nodes(rows.withColumn("k", F.lit("2")), "N", ["k"])
    assert as_set(folder.table("N")) == {("1", "a1", "b1"), ("2", None, None)}
    # A rewrite may read the table it replaces.
    folder.replace("N", folder.table("N").filter("k = '2'"))
    assert folder.table("N", "k").count() == 1
    assert folder.reset("N").count() == 0
