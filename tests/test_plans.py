"""Plans: what reaches the scan, what is shuffled, and what happens to a hot key."""

import pathlib

import pytest
from pyspark.sql import functions as F

from kinweave.catalog import shapes
from kinweave.catalog.shapes import table
from kinweave.operators.keys import keep_one, last_wins
from kinweave.operators.neighbours import topk_similarity
from kinweave.operators.paths import Graph, incoming_counts
from kinweave.operators.upsert import merge_edges
from kinweave.session import materialise, shared_dir

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_endpoint_is_split(spark, conf):
    """A third of all edges ends in one node; without broadcast the join splits it."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    # A partition is split by the tasks that wrote it, so on small data these must stay many.
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")
    n = 60_000
    edges = spark.range(n).repartition(8).select(
        F.concat(F.lit("src"), F.col("id").cast("string")).alias("src"),
        F.when(F.col("id") % 3 == 0, "hot")
        .otherwise(F.concat(F.lit("n"), (F.col("id") % 997).cast("string")))
        .alias("dst"),
    )
    sources = materialise(edges.select(F.col("src").alias("id")), "sources")
    targets = materialise(edges.select(F.col("dst").alias("id")).distinct(), "targets")
    table_ = merge_edges(None, edges, sources, "id", targets, "id").table
    assert len(table_.collect()) == n
    assert "skew=true" in plan_of(table_)


def test_batches_are_reduced_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = plan_of(last_wins(df, ["k"], ["v"], "v"))
    assert "partial_max_by" in plan
    plan = plan_of(keep_one(df, ["k"], ["v"]))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_incoming_edges_are_counted_before_the_join(spark):
    nodes = spark.createDataFrame([("a", "Bohr")], "id string, fullName string")
    edges = spark.createDataFrame([("x", "a")], "src string, dst string")
    graph = Graph({"S": nodes}, {"S": "id"}, {"M": edges}, {"M": ("S", "S")})
    plan = plan_of(incoming_counts(graph, "M", "fullName", ["Bohr"], "n"))
    join = plan.index("Join")
    assert "partial_count" in plan[join:]


def test_scans_are_pruned_and_filtered(spark):
    from kinweave.catalog import QUERIES

    plan = plan_of(QUERIES["b3_contains_or"](spark, SF_DIR))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan
    plan = plan_of(QUERIES["g1_merge_nodes"](spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(o_orderstatus), Not(EqualTo(o_orderstatus,P))" in plan
    assert "o_totalprice" not in plan


@pytest.mark.parametrize(
    "name",
    ["f2_stack_entities", "f4_prizes_frame", "f5_affiliations_frame", "f9_reshape_raw", "c3_enrich_tree",
     "g2_merge_edges", "g9_city_upsert", "g11_mentored", "g22_two_hop", "h4_topk_similarity", "h7_candidates"],
)
def test_no_cross_joins_and_no_single_task_windows(spark, name):
    from kinweave.catalog import QUERIES

    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "Exchange SinglePartition"):
        assert bad not in plan


def test_small_right_side_needs_no_shuffle_of_the_left(spark):
    rows = table(spark, SF_DIR, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector")
    )
    plan = plan_of(topk_similarity(rows, rows, 3))
    assert "MapInArrow" in plan and "Exchange" not in plan


def test_person_queries_do_not_read_lines(spark):
    from kinweave.catalog import QUERIES

    for name in ("f6_persons_frame", "g3_person_nodes", "b18_repair_date"):
        plan = plan_of(QUERIES[name](spark, SF_DIR))
        assert "customer" in plan and "lineitem" not in plan and "orders" not in plan


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_sources_avoid_what_does_not_scale():
    code = {
        p: p.read_text() for p in (pathlib.Path(__file__).parent.parent / "kinweave").rglob("*.py")
    }
    for bad in ("localCheckpoint", "crossJoin", ".toPandas(", ".rdd", "F.udf("):
        assert not [p for p, text in code.items() if bad in text], bad


def test_the_texts_of_order_lines_are_looked_up_after_the_last_shuffle_of_lines(spark):
    ref = shapes.reference(spark, SF_DIR)
    plan = ref._jdf.queryExecution().optimizedPlan().toString()
    # From the top: the supplier meets the lines above the deal to the customers, by broadcast.
    assert plan.index("s_suppkey") < plan.index("RepartitionByExpression [o_custkey")
    ref.collect()
    text = plan_of(ref)
    lines = [x for x in text.splitlines() if "Exchange hashpartitioning" in x]
    assert lines and not any("s_name" in x or "affiliations" in x for x in lines)


def test_lines_of_unknown_suppliers_and_orders_without_lines(spark, tmp_path):
    for name in ("region", "nation", "customer", "supplier", "orders", "lineitem"):
        rows = table(spark, SF_DIR, name)
        if name == "supplier":
            rows = rows.filter("s_suppkey % 2 = 0")
        if name == "lineitem":
            rows = rows.filter("l_orderkey % 3 > 0")
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    d = str(tmp_path)
    ref = shapes.reference(spark, d)
    got = {
        r.o_orderkey: r.n
        for r in ref.select(F.explode("prizes").alias("p"))
        .select("p.o_orderkey", F.size("p.affiliations").alias("n")).collect()
    }
    kept = table(spark, d, "lineitem").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    want = {r.o_orderkey: 0 for r in table(spark, d, "orders").select("o_orderkey").collect()}
    want.update({r.l_orderkey: r["count"] for r in kept.groupBy("l_orderkey").count().collect()})
    assert got == want
    assert ref.count() == table(spark, d, "customer").count()


def test_the_lists_of_the_tree_are_gathered_after_the_last_shuffle(spark, conf):
    """Customers meet the flat orders, so that no shuffle moves a list, and a parent's fixed
    fields are not gathered."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    tree = shapes.tree(spark, SF_DIR)
    lines = tree._jdf.queryExecution().sparkPlan().toString().splitlines()
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    gathered = next(i for i, x in enumerate(lines) if "collect_list" in x)
    above = [x for i, x in enumerate(lines[:gathered]) if depth[i] < min(depth[i + 1 : gathered + 1])]
    assert above and not any("c_custkey" in x for x in above if "Join" in x)
    assert not any("collect_list" in x and "scholar" in x for x in lines)
    orders = table(spark, SF_DIR, "orders")
    assert tree.count() == tree.select("entry_id").distinct().count() == orders.count()


def test_mentor_rows_are_grouped_where_they_were_dealt(spark):
    """The number of tasks that make and count the rows is given, not found from their bytes."""
    from kinweave.operators.reshape import mentor_pairs

    tree = materialise(shapes.tree_with_ids(spark, SF_DIR), "tree")
    got = {}
    for partitions in (None, 11):
        pairs = mentor_pairs(tree, partitions=partitions)
        counted = pairs.groupBy(*pairs.columns).agg(F.count(F.lit(1)).alias("n"))
        got[partitions] = sorted(map(str, counted.collect()))
    assert got[11] == got[None]
    assert counted.rdd.getNumPartitions() == 11
