"""Queries for sources, scalar columns, joins, aggregates and order."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.catalog import shapes
from kinweave.catalog.registry import query
from kinweave.catalog.shapes import table
from kinweave.catalog.sql import build
from kinweave.functions import columns as C
from kinweave.functions.checks import validate
from kinweave.operators import keys, numbering, reshape
from kinweave.operators.paths import Graph, Hop, match
from kinweave.operators.upsert import match_endpoints
from kinweave.schemas import TREE
from kinweave.session import materialise, shared_dir
from kinweave.sources.records import assemble_pages, read_records, write_records
from kinweave.sources.tables import DuplicateKeyError, GraphFolder, pk_violations


def scratch(spark, name):
    return f"{shared_dir(spark)}/kinweave/{name}-{uuid.uuid4().hex}"


# --- sources and sinks ---


@query(
    "a1_json_roundtrip",
    build("""SELECT name, category, count(*) AS n FROM (
                 SELECT name, category FROM children UNION ALL SELECT name, category FROM parents)
             GROUP BY ALL"""),
)
def a1(spark, d):
    path = scratch(spark, "tree")
    write_records(shapes.tree(spark, d).select("children", "parents"), path)
    back = read_records(spark, path, TREE)
    items = back.select(F.explode(F.concat("children", "parents")).alias("x"))
    return items.groupBy("x.name", "x.category").agg(F.count(F.lit(1)).alias("n"))


@query("a2_page_assemble", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def a2(spark, d):
    path = scratch(spark, "pages")
    record = F.struct("c_custkey", "c_name", "c_mktsegment")
    pages = (
        table(spark, d, "customer")
        .groupBy(F.expr("c_custkey div 25").alias("page"))
        .agg(F.collect_list(record).alias("records"))  # 25 keys to a page
        .select("records")
    )
    write_records(pages, path)
    return assemble_pages(spark, path, pages.schema, "records")


@query("a4_load_nodes_pk", "SELECT c_name AS name, c_mktsegment AS segment, 1 AS n_refused FROM customer")
def a4(spark, d):
    schema = T.StructType().add("name", "string").add("segment", "string")
    folder = GraphFolder(spark, scratch(spark, "folder"))
    folder.declare_node("Person", schema, "name")
    rows = table(spark, d, "customer").select(
        F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"), "c_acctbal"
    )
    folder.load_nodes(rows.filter("c_acctbal < 0"), "Person")
    folder.load_nodes(rows.filter("c_acctbal >= 0"), "Person", ["name", "segment"])
    refused = 0
    try:
        folder.load_nodes(rows, "Person")
    except DuplicateKeyError:
        refused = 1
    return folder.table("Person").withColumn("n_refused", F.lit(refused))


@query("a6_scan_project_sort", "SELECT s_name AS name, s_acctbal AS balance FROM supplier ORDER BY 1")
def a6(spark, d):
    schema = T.StructType().add("key", "long").add("name", "string").add("balance", "double")
    folder = GraphFolder(spark, scratch(spark, "folder"))
    folder.declare_node("Supplier", schema, "key")
    folder.replace(
        "Supplier",
        table(spark, d, "supplier").select(
            F.col("s_suppkey").alias("key"),
            F.col("s_name").alias("name"),
            F.col("s_acctbal").alias("balance"),
        ),
    )
    return folder.table("Supplier", "name", "balance").orderBy("name")


@query(
    "a8_pk_violations",
    """SELECT l_orderkey || '/' || l_linenumber AS pk, count(*) AS n_rows
       FROM lineitem GROUP BY 1 HAVING count(*) > 1""",
)
def a8(spark, d):
    keyed = table(spark, d, "lineitem").select(
        C.make_key("l_orderkey", "l_linenumber", sep="/").alias("pk")
    )
    return pk_violations(keyed, "pk")


# --- predicates and scalar columns ---


@query(
    "b1_filter_type",
    build("SELECT name, count(*) AS n FROM entities WHERE type = 'laureate' GROUP BY name"),
)
def b1(spark, d):
    entities = reshape.stack_entities(shapes.tree(spark, d), sort=False)
    return (
        entities.filter(F.col("type") == "laureate").groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "b2_not_null",
    build("""SELECT id, city, country FROM persons WHERE city IS NOT NULL AND country IS NOT NULL"""),
)
def b2(spark, d):
    return (
        reshape.persons_frame(shapes.people(spark, d))
        .filter(F.col("birthPlaceCity").isNotNull() & F.col("birthPlaceCountryNow").isNotNull())
        .select(
            "id",
            F.col("birthPlaceCity").alias("city"),
            F.col("birthPlaceCountryNow").alias("country"),
        )
    )


@query(
    "b3_contains_or",
    "SELECT c_custkey, c_name FROM customer WHERE contains(c_name, '77') OR contains(c_name, '42')",
)
def b3(spark, d):
    return (
        table(spark, d, "customer")
        .filter(C.contains_any(F.col("c_name"), "77", "42"))
        .select("c_custkey", "c_name")
    )


RELEVANT = "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE category END IS DISTINCT FROM 'Peace'"


@query(
    "b4_exclude_categories_exists",
    build(f"""SELECT CAST(custkey AS VARCHAR) AS id, count(*) AS n_prizes FROM prize
              GROUP BY custkey HAVING bool_or({RELEVANT})"""),
)
def b4_exists(spark, d):
    kept = reshape.select_relevant(
        shapes.raw(spark, d), reshape.EXCLUDED_CATEGORIES, mode="exists"
    )
    return kept.select("id", F.size("nobelPrizes").cast("long").alias("n_prizes"))


@query(
    "b4_exclude_categories_per_prize",
    build(f"""SELECT CAST(p.custkey AS VARCHAR) AS id, n_prizes FROM prize p
              JOIN (SELECT custkey, count(*) AS n_prizes FROM prize GROUP BY ALL) r
              ON r.custkey = p.custkey WHERE {RELEVANT}"""),
)
def b4_per_prize(spark, d):
    kept = reshape.select_relevant(
        shapes.raw(spark, d), reshape.EXCLUDED_CATEGORIES, mode="per_prize"
    )
    return kept.select("id", F.size("nobelPrizes").cast("long").alias("n_prizes"))


@query(
    "b5_flatten_paths",
    build("""SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS known_name, c_name AS full_name,
                    CASE c_custkey % 7 WHEN 0 THEN '1898-00-00' WHEN 1 THEN '1898-07-00'
                         WHEN 2 THEN 'garbage' WHEN 3 THEN ''
                         ELSE (1900 + c_custkey % 90) || '-02-03' END AS birth_date,
                    'City ' || c_nationkey || CASE c_custkey % 2 WHEN 0 THEN ', ' || r_name ELSE '' END
                        AS birth_city,
                    CASE WHEN c_nationkey % 5 <> 0 THEN n_name END AS birth_country,
                    r_name AS continent
             FROM record"""),
)
def b5(spark, d):
    flat = reshape.flatten_paths(shapes.raw(spark, d), [])
    return flat.select(
        "id",
        F.col("knownName").alias("known_name"),
        F.col("fullName").alias("full_name"),
        F.col("birthDate").alias("birth_date"),
        F.col("birthPlaceCity").alias("birth_city"),
        F.col("birthPlaceCountryNow").alias("birth_country"),
        F.col("birthPlaceContinent").alias("continent"),
    )


@query(
    "b6_reshape_prizes",
    build("""SELECT CAST(p.custkey AS VARCHAR) AS id, p.award_year,
                    CASE WHEN p.o_orderkey % 13 <> 0 THEN p.category END AS category,
                    p.amount, a.name_now, a.raw_city AS city
             FROM prize p LEFT JOIN affiliation a
             ON a.o_orderkey = p.o_orderkey"""),
)
def b6(spark, d):
    slim = shapes.raw(spark, d).select("id", reshape.slim_prizes(F.col("nobelPrizes")).alias("prizes"))
    prizes = slim.select("id", F.explode("prizes").alias("p"))
    return prizes.select("id", "p", F.explode_outer("p.affiliations").alias("a")).select(
        "id",
        F.col("p.awardYear").alias("award_year"),
        F.col("p.category").alias("category"),
        F.col("p.prizeAmount").alias("amount"),
        F.col("a.nameNow").alias("name_now"),
        F.col("a.city").alias("city"),
    )


@query(
    "b7_explode_unnest",
    build("SELECT entry_id, p.name, p.type FROM entry LEFT JOIN parents p USING (entry_id)"),
)
def b7(spark, d):
    entries = shapes.tree(spark, d).select("entry_id", "parents")
    return reshape.explode_unnest(entries, "parents").select("entry_id", "name", "type")


@query(
    "b8_explode_affiliations",
    build("""SELECT CAST(custkey AS VARCHAR) AS id, award_year, name_now, raw_city AS city_now
             FROM affiliation"""),
)
def b8(spark, d):
    return (
        shapes.reference(spark, d)
        .select("id", F.explode("prizes").alias("p"))
        .select("id", F.col("p.awardYear").alias("award_year"), F.explode("p.affiliations").alias("a"))
        .select(
            "id",
            "award_year",
            F.col("a.nameNow").alias("name_now"),
            F.col("a.cityNow").alias("city_now"),
        )
    )


@query(
    "b11_make_key",
    build("""SELECT name, type, CAST(year AS VARCHAR) AS year,
                    lower(name) || ' ' || lower(category) || ' ' || year AS pk FROM entities"""),
)
def b11(spark, d):
    entities = reshape.stack_entities(shapes.tree(spark, d), sort=False)
    return entities.select(
        "name",
        "type",
        F.col("year").cast("string").alias("year"),
        C.make_key(F.lower("name"), F.lower("category"), F.col("year")).alias("pk"),
    )


@query(
    "b13_coalesce_key",
    build("""SELECT DISTINCT name, lower(name) || ' ' || coalesce(lower(category), 'no prize') AS pk
             FROM entities WHERE name IS NOT NULL"""),
)
def b13(spark, d):
    entities = reshape.stack_entities(shapes.tree(spark, d), sort=False).filter("name IS NOT NULL")
    key = C.make_key(F.lower("name"), F.coalesce(F.lower("category"), F.lit("no prize")))
    return entities.select("name", key.alias("pk")).distinct()


@query(
    "b14_replace_first",
    r"""SELECT p_name, p_type, regexp_replace(p_name, ' ', '_') AS one_gap,
               lower(regexp_replace(p_type, 'A', '<a>')) AS one_letter FROM part""",
)
def b14(spark, d):
    return table(spark, d, "part").select(
        "p_name",
        "p_type",
        C.replace_first(F.col("p_name"), " ", "_").alias("one_gap"),
        F.lower(C.replace_first(F.col("p_type"), "A", "<a>")).alias("one_letter"),
    )


@query(
    "b15_canonicalise",
    build("""SELECT CASE category WHEN 'Physiology or Medicine' THEN 'Medicine'
                    WHEN 'Economic Sciences' THEN 'Economics' ELSE category END AS category,
                    count(*) AS n FROM prize GROUP BY 1"""),
)
def b15(spark, d):
    prizes = shapes.reference(spark, d).select(F.explode("prizes.category").alias("c"))
    name = C.canonicalise(F.col("c"), C.CATEGORY_NAMES)
    return prizes.groupBy(name.alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "b16_strict_cast",
    build("""SELECT CAST(award_year AS BIGINT) AS award_year, count(*) AS n, CAST(sum(amount) AS BIGINT)
             AS amount FROM prize GROUP BY 1"""),
)
def b16(spark, d):
    prizes = shapes.reference(spark, d).select(F.explode("prizes").alias("p"))
    return prizes.groupBy(C.strict_long(F.col("p.awardYear")).alias("award_year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("p.prizeAmount").alias("amount")
    )


@query(
    "b17_to_date",
    build("""SELECT CAST(date_diff('day', DATE '1990-01-01', CAST(awarded AS DATE)) AS BIGINT) AS day,
                    count(*) AS n FROM prize GROUP BY 1"""),
)
def b17(spark, d):
    prizes = shapes.reference(spark, d).select(F.explode("prizes.dateAwarded").alias("t"))
    day = F.date_diff(C.strict_date(F.col("t")), F.lit("1990-01-01").cast("date")).cast("long")
    return prizes.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("b18_repair_date", build("SELECT id, birth_date FROM persons"))
def b18(spark, d):
    ref = shapes.people(spark, d)
    return ref.select(
        F.concat(F.lit("l"), "id").alias("id"),
        C.repair_date(F.col("birthDate")).cast("string").alias("birth_date"),
    )


@query(
    "b19_prefix_id",
    """SELECT s_suppkey, 'l' || s_suppkey AS plain,
              CASE WHEN s_nationkey % 2 = 0 THEN 'l' || s_suppkey ELSE 'l' || s_name END AS mixed
       FROM supplier""",
)
def b19(spark, d):
    given = F.when(
        F.col("s_nationkey") % 2 == 0, F.concat(F.lit("l"), F.col("s_suppkey").cast("string"))
    ).otherwise(F.col("s_name"))
    return table(spark, d, "supplier").select(
        "s_suppkey",
        F.concat(F.lit("l"), F.col("s_suppkey").cast("string")).alias("plain"),
        C.prefix_id(given, "l").alias("mixed"),
    )


@query("b20_split_city_person", build("SELECT id, city, state FROM persons"))
def b20(spark, d):
    city = F.col("birthPlaceCity")
    return shapes.people(spark, d).select(
        F.concat(F.lit("l"), "id").alias("id"),
        C.person_city(city).alias("city"),
        C.person_state(city).alias("state"),
    )


@query(
    "b21_split_city_affil",
    build("SELECT raw_city, city, state, count(*) AS n FROM affiliation GROUP BY ALL"),
)
def b21(spark, d):
    city = F.col("raw_city")
    return (
        shapes.reference(spark, d)
        .select(F.explode("prizes").alias("p"))
        .select(F.explode("p.affiliations.cityNow").alias("raw_city"))
        .groupBy("raw_city")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "raw_city",
            C.affiliation_city(city).alias("city"),
            C.affiliation_state(city).alias("state"),
            "n",
        )
    )


@query(
    "b22_validate_split",
    """SELECT doc_id, CASE WHEN quality IS NULL THEN 'missing quality' ELSE
              CASE WHEN quality <> 1 THEN 'bad quality' ELSE '' END END AS errors
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def b22(spark, d):
    rows = table(spark, d, "documents").select("doc_id").join(
        table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left"
    )
    split = validate(rows, ["doc_id", "quality"], {"quality": [1]}, on_error="quarantine")
    valid = split.valid.select("doc_id", F.lit("").alias("errors"))
    return valid.unionByName(
        split.rejected.select("doc_id", F.array_join("errors", ", ").alias("errors"))
    )


@query(
    "b23_case_prefix",
    """SELECT CASE WHEN starts_with(id, 'l') THEN 'laureate' WHEN starts_with(id, 's') THEN 'scholar'
              ELSE NULL END AS kind, count(*) AS n FROM (
           SELECT 'l' || c_custkey AS id FROM customer UNION ALL
           SELECT 's' || s_suppkey FROM supplier UNION ALL SELECT 'x' || n_nationkey FROM nation)
       GROUP BY 1""",
)
def b23(spark, d):
    def ids(name, key, prefix):
        return table(spark, d, name).select(F.concat(F.lit(prefix), F.col(key).cast("string")).alias("id"))

    rows = ids("customer", "c_custkey", "l").unionByName(ids("supplier", "s_suppkey", "s"))
    rows = rows.unionByName(ids("nation", "n_nationkey", "x"))
    return rows.groupBy(C.kind_from_id(F.col("id")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


# --- joins ---


# Pairs of names whose rows one task makes and counts.
PAIRS_OF_TASK = 250_000


@query(
    "c1_left_join_twice",
    build("""SELECT parent_name, child_name, parent_id, child_id, count(*) AS n
             FROM mentor_rows GROUP BY ALL"""),
)
def c1(spark, d):
    # All rows are made; they are compared as counts, of which there are far fewer.
    tree = materialise(shapes.tree_with_ids(spark, d), "tree")
    made = F.greatest(F.size("children"), F.lit(1)).cast("long") * F.greatest(F.size("parents"), F.lit(1))
    n_pairs = tree.agg(F.coalesce(F.sum(made), F.lit(0))).first()[0]
    tasks = max(spark.sparkContext.defaultParallelism, -(-n_pairs // PAIRS_OF_TASK))
    pairs = reshape.mentor_pairs(tree, partitions=tasks)
    return pairs.groupBy(*pairs.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    "c2_endpoint_match",
    """SELECT DISTINCT o_custkey AS src, l_suppkey AS dst
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
         AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)""",
)
def c2(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    edges = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(F.col("o_custkey").alias("src"), F.col("l_suppkey").alias("dst"))
        .distinct()
    )
    return match_endpoints(
        edges,
        table(spark, d, "customer").filter("c_acctbal >= 0"),
        "c_custkey",
        table(spark, d, "supplier").filter("s_acctbal >= 0"),
        "s_suppkey",
    )


@query("c3_enrich_tree", build("SELECT entry_id, grp, CAST(pos AS BIGINT) AS pos, name, id FROM elements"))
def c3(spark, d):
    done = materialise(shapes.tree_with_ids(spark, d), "tree")
    parts = [
        done.select("entry_id", F.lit(g).alias("grp"), F.posexplode(g).alias("pos", "x"))
        for g in ("children", "parents")
    ]
    return (
        parts[0]
        .unionByName(parts[1])
        .select("entry_id", "grp", F.col("pos").cast("long").alias("pos"), "x.name", "x.id")
    )


@query(
    "c4_pattern_join",
    """SELECT c_custkey AS customer_id, c_name AS customer_name, o_orderkey AS order_id
       FROM customer JOIN orders ON o_custkey = c_custkey WHERE contains(c_name, '7')""",
)
def c4(spark, d):
    customers = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name")
    )
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("owner")
    )
    graph = Graph(
        nodes={"Customer": customers, "Order": orders.select("id")},
        keys={"Customer": "id", "Order": "id"},
        edges={"PLACED": orders.select(F.col("owner").alias("src"), F.col("id").alias("dst"))},
        ends={"PLACED": ("Customer", "Order")},
    )
    return match(
        graph, "Customer", "customer", [Hop("PLACED", "order")], F.col("name").contains("7")
    )


@query("c5_pairs", build("SELECT parent_name, child_name, count(*) AS n FROM pairs GROUP BY ALL"))
def c5(spark, d):
    entries = shapes.tree(spark, d)
    return (
        entries.select(F.explode_outer("children.name").alias("child_name"), "parents")
        .select("child_name", F.explode_outer("parents.name").alias("parent_name"))
        .groupBy("parent_name", "child_name")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --- aggregates and duplicates ---


@query("d1_distinct", "SELECT DISTINCT l_orderkey, l_suppkey, l_returnflag FROM lineitem")
def d1(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag").distinct()


@query("d2_distinct_proj", build("SELECT DISTINCT city, state FROM affiliations WHERE city IS NOT NULL"))
def d2(spark, d):
    rows = reshape.affiliations_frame(shapes.reference(spark, d)).filter("cityNow IS NOT NULL")
    return rows.select(F.col("cityNow").alias("city"), F.col("stateNow").alias("state")).distinct()


@query(
    "d3_keep_one",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM (
           SELECT *, row_number() OVER (PARTITION BY l_orderkey
                     ORDER BY l_linenumber, l_suppkey, l_partkey) AS rk FROM lineitem) WHERE rk = 1""",
)
def d3(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return keys.keep_one(lines, ["l_orderkey"], ["l_linenumber", "l_suppkey", "l_partkey"])


@query(
    "d4_counts",
    build("""SELECT count(*) AS n_rows, count(name) AS n_named, count(category) AS n_prized
             FROM entities"""),
)
def d4(spark, d):
    entities = reshape.stack_entities(shapes.tree(spark, d), sort=False)
    return entities.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("name").alias("n_named"),
        F.count("category").alias("n_prized"),
    )


@query(
    "d5_count_distinct",
    build("""SELECT count(DISTINCT (city, state)) AS n_pairs, count(DISTINCT city) AS n_cities
             FROM affiliations"""),
)
def d5(spark, d):
    rows = reshape.affiliations_frame(shapes.reference(spark, d))
    return rows.agg(
        F.count_distinct(F.struct("cityNow", "stateNow")).alias("n_pairs"),
        F.count_distinct("cityNow").alias("n_cities"),
    )


@query(
    "d6_mentor_count",
    build("""SELECT child_name, count(*) AS n_mentors FROM
             (SELECT DISTINCT parent_name, child_name FROM pairs WHERE parent_name IS NOT NULL)
             GROUP BY child_name"""),
)
def d6(spark, d):
    pairs = (
        shapes.tree(spark, d)
        .select(F.explode("children.name").alias("child_name"), "parents")
        .select("child_name", F.explode("parents.name").alias("parent_name"))
        .distinct()
    )
    return pairs.groupBy("child_name").agg(F.count(F.lit(1)).alias("n_mentors"))


@query(
    "d7_last_wins",
    """SELECT o_custkey, (b).o_orderstatus AS status, (b).prio AS priority FROM (
           SELECT o_custkey, arg_max(struct_pack(o_orderstatus,
                  prio := CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END),
                  (o_orderdate, o_orderkey)) AS b
           FROM orders GROUP BY o_custkey)""",
)
def d7(spark, d):
    orders = table(spark, d, "orders").select(
        "o_custkey",
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        "o_orderdate",
        "o_orderkey",
    )
    return keys.last_wins(
        orders, ["o_custkey"], ["status", "priority"], F.struct("o_orderdate", "o_orderkey")
    )


# --- order, limits, numbers ---


@query(
    "e1_sort",
    """SELECT c_mktsegment, c_name, c_custkey,
              row_number() OVER (ORDER BY c_mktsegment, c_name, c_custkey) AS position FROM customer""",
)
def e1(spark, d):
    rows = table(spark, d, "customer").select("c_mktsegment", "c_name", "c_custkey")
    return numbering.assign_index(rows, ["c_mktsegment", "c_name", "c_custkey"], "position")


@query(
    "e2_topk_per_group",
    """SELECT c_nationkey, c_custkey, rk AS rank FROM (
           SELECT *, row_number() OVER (PARTITION BY c_nationkey
                     ORDER BY c_acctbal DESC, c_custkey) AS rk FROM customer) WHERE rk <= 3""",
)
def e2(spark, d):
    rows = table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    top = keys.top_k_per_group(rows, ["c_nationkey"], [F.col("c_acctbal").desc(), "c_custkey"], 3)
    return top.select("c_nationkey", "c_custkey", F.col("rank").cast("long").alias("rank"))


@query(
    "e3_slice",
    """SELECT c_name, c_custkey FROM customer ORDER BY c_name, c_custkey LIMIT 90 OFFSET 10""",
)
def e3(spark, d):
    rows = table(spark, d, "customer").select("c_name", "c_custkey")
    return numbering.slice_rows(rows, ["c_name", "c_custkey"], 10, 100)


@query(
    "e4_assign_ids",
    """SELECT o_orderkey, 's' || row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id
       FROM orders""",
)
def e4(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return numbering.assign_ids(orders, ["o_orderdate", "o_orderkey"], "s").select("o_orderkey", "id")


# --- set operations and frames ---


@query(
    "f1_union",
    build("SELECT name, type, count(*) AS n FROM entities_all GROUP BY ALL"),
)
def f1(spark, d):
    entries = shapes.tree(spark, d)
    sides = [reshape.explode_unnest(entries.select(g), g) for g in ("children", "parents")]
    return sides[0].unionByName(sides[1]).groupBy("name", "type").agg(F.count(F.lit(1)).alias("n"))


def text_year(df):
    return df.withColumn("year", F.col("year").cast("string"))


@query(
    "f2_stack_entities",
    build("SELECT name, type, category, CAST(year AS VARCHAR) AS year FROM entities"),
)
def f2(spark, d):
    return text_year(reshape.stack_entities(shapes.tree(spark, d)))


@query("f3_entity_ids", build("SELECT name, id FROM scholar_ids"))
def f3(spark, d):
    return reshape.entity_ids(shapes.tree(spark, d)).select("name", "id")


@query(
    "f4_prizes_frame",
    build("""SELECT short AS category, person AS laureate_id, prize_id, portion,
                    CAST(award_year AS BIGINT) AS award_year, awarded AS date_awarded, motivation,
                    amount, 2 * amount AS adjusted FROM prizes"""),
)
def f4(spark, d):
    return reshape.prizes_frame(shapes.reference(spark, d)).select(
        "category",
        "laureate_id",
        "prize_id",
        "portion",
        F.col("awardYear").alias("award_year"),
        F.col("dateAwarded").cast("string").alias("date_awarded"),
        "motivation",
        F.col("prizeAmount").alias("amount"),
        F.col("prizeAmountAdjusted").alias("adjusted"),
    )


@query(
    "f5_affiliations_frame",
    build("SELECT person, name_now, city, state, country, continent FROM affiliations"),
)
def f5(spark, d):
    return reshape.affiliations_frame(shapes.reference(spark, d)).toDF(
        "person", "name_now", "city", "state", "country", "continent"
    )


@query(
    "f6_persons_frame",
    build("SELECT id, name, gender, birth_date, city, state, country FROM persons"),
)
def f6(spark, d):
    return reshape.persons_frame(shapes.people(spark, d)).select(
        "id",
        F.col("fullName").alias("name"),
        "gender",
        F.col("birthDate").cast("string").alias("birth_date"),
        F.col("birthPlaceCity").alias("city"),
        F.col("birthPlaceState").alias("state"),
        F.col("birthPlaceCountryNow").alias("country"),
    )


@query(
    "f7_laureate_keys",
    build("""SELECT name, CAST(year AS VARCHAR) AS year,
                    lower(name) || ' ' || lower(category) || ' ' || year AS pk
             FROM entities WHERE type = 'laureate'"""),
)
def f7(spark, d):
    return text_year(reshape.laureate_keys(shapes.tree(spark, d))).select("name", "year", "pk")


@query(
    "f8_reference_keys",
    build("""SELECT CAST(c_custkey AS VARCHAR) AS id,
                    lower(c_name) || ' ' || lower(category) || ' ' || award_year AS pk
             FROM record r LEFT JOIN prize p ON p.custkey = c_custkey"""),
)
def f8(spark, d):
    return reshape.reference_keys(shapes.reference(spark, d)).select("id", "pk")


@query(
    "f9_reshape_raw",
    build(f"""SELECT CAST(p.custkey AS VARCHAR) AS id, c_name AS full_name, n_prizes, n_affiliations
              FROM prize p JOIN customer ON c_custkey = p.custkey
              JOIN (SELECT custkey, count(*) AS n_prizes FROM prize GROUP BY ALL) r
              ON r.custkey = p.custkey
              LEFT JOIN (SELECT custkey, count(*) AS n_aff FROM affiliation GROUP BY ALL) a
              ON a.custkey = p.custkey,
              LATERAL (SELECT coalesce(n_aff, 0) AS n_affiliations) WHERE {RELEVANT}"""),
)
def f9(spark, d):
    ref = reshape.reshape_raw(shapes.raw(spark, d))
    sizes = F.aggregate("prizes", F.lit(0), lambda n, p: n + F.size(p["affiliations"]))
    return ref.select(
        "id",
        F.col("fullName").alias("full_name"),
        F.size("prizes").cast("long").alias("n_prizes"),
        sizes.cast("long").alias("n_affiliations"),
    )


@query(
    "f10_mentor_pairs",
    build("""SELECT parent_name, child_name, parent_id, child_id, count(*) AS n_rows
             FROM mentor_rows GROUP BY ALL"""),
)
def f10(spark, d):
    tree = materialise(shapes.tree_with_ids(spark, d), "tree")
    return reshape.mentor_pairs(tree, weighted=True)


