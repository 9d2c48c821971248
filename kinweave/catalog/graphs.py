"""Queries for the property graph."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from kinweave.catalog import shapes
from kinweave.catalog.columns import scratch
from kinweave.catalog.registry import query
from kinweave.catalog.shapes import table
from kinweave.catalog.sql import build
from kinweave.operators.paths import Graph, Hop, incoming_counts, lookup, match
from kinweave.operators.reshape import (
    affiliations_frame,
    persons_frame,
    prizes_frame,
    stack_entities,
)
from kinweave.operators.upsert import merge_edges, merge_nodes
from kinweave.plans import graph as G
from kinweave.schemas import EDGES, NODES
from kinweave.session import materialise
from kinweave.sources.tables import GraphFolder


class Parts:
    """The frames and node tables of the graph over the given tables.

    What several steps of one query read is written once and read back pruned.
    """

    def __init__(self, spark, d):
        self.spark, self.d = spark, d

    # The three frames prune the records differently, so each starts from the lazy plan.

    @cached_property
    def persons(self):
        return materialise(persons_frame(shapes.people(self.spark, self.d)), "persons")

    @cached_property
    def affiliations(self):
        ref = shapes.reference(self.spark, self.d)
        return materialise(affiliations_frame(ref), "affiliations")

    @cached_property
    def prizes(self):
        return materialise(prizes_frame(shapes.reference(self.spark, self.d)), "prizes")

    @cached_property
    def tree(self):
        return materialise(shapes.tree_with_ids(self.spark, self.d), "tree")

    @cached_property
    def laureates(self):
        return materialise(G.person_nodes(None, self.persons).table, "laureates")

    @cached_property
    def scholars(self):
        entities = stack_entities(self.tree, sort=False)
        return materialise(G.scholar_nodes(self.laureates, entities).table, "scholars")

    @cached_property
    def cities(self):
        birth = G.birth_city_nodes(None, self.persons).table
        return materialise(G.affiliation_city_nodes(birth, self.affiliations).table, "cities")

    @cached_property
    def countries(self):
        return materialise(G.birth_country_nodes(None, self.persons).table, "countries")

    @cached_property
    def institutions(self):
        return materialise(G.institution_nodes(None, self.affiliations).table, "institutions")

    @cached_property
    def continents(self):
        return materialise(G.continent_nodes(None, self.affiliations).table, "continents")


@query(
    "g1_merge_nodes",
    """SELECT c_custkey AS id, c_name AS name,
              CASE WHEN b IS NULL THEN 'none' ELSE (b).s END AS status,
              CASE WHEN b IS NULL THEN c_mktsegment ELSE (b).p END AS note
       FROM customer LEFT JOIN (
           SELECT o_custkey, arg_max(struct_pack(s := o_orderstatus,
                  p := CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END),
                  (o_orderdate, o_orderkey)) AS b
           FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey) ON o_custkey = c_custkey""",
)
def g1(spark, d):
    existing = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.lit("none").alias("status"),
        F.col("c_mktsegment").alias("note"),
    )
    incoming = (
        table(spark, d, "orders")
        .filter("o_orderstatus <> 'P'")
        .select(
            F.col("o_custkey").alias("id"),
            F.col("o_orderstatus").alias("status"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("note"),
            "o_orderdate",
            "o_orderkey",
        )
    )
    order = F.struct("o_orderdate", "o_orderkey")
    return merge_nodes(existing, incoming, "id", ["status", "note"], order).table


@query(
    "g2_merge_edges",
    """WITH e AS (SELECT o_custkey AS src, l_suppkey AS dst, l_linestatus, l_returnflag
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
            old AS (SELECT DISTINCT src, dst FROM e WHERE l_linestatus = 'F'),
            new AS (SELECT src, dst, max(l_returnflag) AS flag FROM e WHERE l_linestatus = 'O'
                    AND src IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
                    AND dst IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) GROUP BY ALL)
       SELECT coalesce(o.src, n.src) AS src, coalesce(o.dst, n.dst) AS dst,
              CASE WHEN n.src IS NOT NULL THEN n.flag ELSE 'old' END AS flag,
              CASE WHEN o.src IS NOT NULL THEN 'kept' END AS note
       FROM old o FULL JOIN new n ON o.src = n.src AND o.dst = n.dst""",
)
def g2(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linestatus", "l_returnflag"
    )
    edges = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("src"),
        F.col("l_suppkey").alias("dst"),
        F.col("l_returnflag").alias("flag"),
        "l_linestatus",
    )
    old = edges.filter("l_linestatus = 'F'").select("src", "dst").distinct()
    existing = old.withColumn("flag", F.lit("old")).withColumn("note", F.lit("kept"))
    return merge_edges(
        existing,
        edges.filter("l_linestatus = 'O'"),
        table(spark, d, "customer").filter("c_acctbal >= 0"),
        "c_custkey",
        table(spark, d, "supplier").filter("s_acctbal >= 0"),
        "s_suppkey",
        ["flag"],
    ).table


@query(
    "g3_person_nodes",
    build("""SELECT id, scholar_type, name, full_name, gender, birth_date FROM g_scholar
             WHERE scholar_type = 'laureate'"""),
)
def g3(spark, d):
    persons = persons_frame(shapes.people(spark, d))
    return G.person_nodes(None, persons).table.select(
        "id",
        "scholar_type",
        "name",
        F.col("fullName").alias("full_name"),
        "gender",
        F.col("birthDate").cast("string").alias("birth_date"),
    )


@query("g4_scholar_nodes", build("SELECT id, scholar_type, name, full_name FROM g_scholar"))
def g4(spark, d):
    return Parts(spark, d).scholars.select("id", "scholar_type", "name", F.col("fullName").alias("full_name"))


@query(
    "g5_prize_nodes",
    build("""SELECT id, CAST(award_year AS BIGINT) AS award_year, category, awarded, motivation, amount
             FROM g_prize"""),
)
def g5(spark, d):
    prizes = prizes_frame(shapes.reference(spark, d))
    return G.prize_nodes(None, prizes).table.select(
        "id",
        F.col("awardYear").alias("award_year"),
        "category",
        F.col("dateAwarded").cast("string").alias("awarded"),
        "motivation",
        F.col("prizeAmount").alias("amount"),
    )


@query("g6_city_nodes", build("SELECT name, state FROM g_birth_city"))
def g6(spark, d):
    return G.birth_city_nodes(None, persons_frame(shapes.people(spark, d))).table


@query("g7_country_nodes", build("SELECT name FROM g_country"))
def g7(spark, d):
    return G.birth_country_nodes(None, persons_frame(shapes.people(spark, d))).table


@query("g8_institution_nodes", build("SELECT DISTINCT name_now AS name FROM affiliations"))
def g8(spark, d):
    return G.institution_nodes(None, affiliations_frame(shapes.reference(spark, d))).table


@query("g9_city_upsert", build("SELECT name, state FROM g_city"))
def g9(spark, d):
    return Parts(spark, d).cities


@query("g10_continent_nodes", build("SELECT DISTINCT continent AS name FROM affiliations"))
def g10(spark, d):
    return G.continent_nodes(None, affiliations_frame(shapes.reference(spark, d))).table


@query("g11_mentored", build("SELECT src, dst FROM g_mentored"))
def g11(spark, d):
    parts = Parts(spark, d)
    return G.mentored_edges(None, parts.tree, parts.scholars).table


@query(
    "g11_mentored_counts",
    build("""SELECT count(*) AS rows_matched, count(DISTINCT (parent_id, child_id)) AS distinct_count
             FROM mentor_rows WHERE parent_id IN (SELECT id FROM g_scholar)
             AND child_id IN (SELECT id FROM g_scholar)"""),
)
def g11_counts(spark, d):
    parts = Parts(spark, d)
    return G.mentored_edges(None, parts.tree, parts.scholars).counts


@query("g12_born_in", build("SELECT DISTINCT id AS src, city AS dst FROM persons"))
def g12(spark, d):
    parts = Parts(spark, d)
    return G.born_in_edges(None, parts.persons, parts.laureates, parts.cities).table


@query("g13_city_in_birth", build("SELECT src, dst FROM g_city_in_birth"))
def g13(spark, d):
    parts = Parts(spark, d)
    return G.birth_city_country_edges(None, parts.persons, parts.cities, parts.countries).table


@query(
    "g14_won",
    build("""SELECT person AS src, prize_id AS dst, max(portion) AS portion
             FROM prizes GROUP BY ALL"""),
)
def g14(spark, d):
    parts = Parts(spark, d)
    prizes = parts.prizes
    return G.won_edges(None, prizes, parts.laureates, G.prize_nodes(None, prizes).table).table


@query("g15_affiliated", build("SELECT DISTINCT person AS src, name_now AS dst FROM affiliations"))
def g15(spark, d):
    parts = Parts(spark, d)
    return G.affiliated_edges(None, parts.affiliations, parts.laureates, parts.institutions).table


@query("g16_located_in", build("SELECT DISTINCT name_now AS src, city AS dst FROM affiliations"))
def g16(spark, d):
    parts = Parts(spark, d)
    return G.located_edges(None, parts.affiliations, parts.institutions, parts.cities).table


@query("g17_city_in_all", build("SELECT src, dst FROM g_city_in"))
def g17(spark, d):
    parts = Parts(spark, d)
    cities, countries = parts.cities, parts.countries
    birth = G.birth_city_country_edges(None, parts.persons, cities, countries).table
    return G.affiliation_city_country_edges(birth, parts.affiliations, cities, countries).table


@query("g18_country_in", build("SELECT src, dst FROM g_country_in"))
def g18(spark, d):
    parts = Parts(spark, d)
    return G.country_continent_edges(
        None, parts.affiliations, parts.countries, parts.continents
    ).table


@query(
    "g20_lookup",
    build("""SELECT CAST(custkey AS VARCHAR) AS id, c_name AS name, category, award_year
             FROM prize JOIN customer ON c_custkey = custkey
             WHERE contains(lower(c_name), '77') OR contains(lower(c_name), '42')
             ORDER BY name, category, award_year"""),
)
def g20(spark, d):
    ref = shapes.reference(spark, d)
    rows = ref.select(
        "id", F.col("fullName").alias("name"), F.lower("fullName").alias("pk"), F.explode("prizes").alias("p")
    ).select(
        "id", "name", "pk", F.col("p.category").alias("category"), F.col("p.awardYear").alias("award_year")
    )
    return lookup(
        rows, "pk", ["77", "42"], ["id", "name", "category", "award_year"],
        ["name", "category", "award_year"],
    )


MENTORS = build("""SELECT full_name, count(*) AS num_mentored
                   FROM g_mentored JOIN g_scholar ON id = dst
                   WHERE contains(full_name, '7') GROUP BY full_name""")


@query("g21_mentor_query", MENTORS)
def g21(spark, d):
    parts = Parts(spark, d)
    graph = Graph(
        nodes={"Scholar": parts.scholars},
        keys={"Scholar": "id"},
        edges={"MENTORED": G.mentored_edges(None, parts.tree, parts.scholars).table},
        ends={"MENTORED": ("Scholar", "Scholar")},
    )
    counts = incoming_counts(graph, "MENTORED", "fullName", ["7"], "num_mentored")
    return counts.withColumnRenamed("fullName", "full_name")


@query(
    "g22_two_hop",
    build("""SELECT DISTINCT person, name_now AS institution, a.city, state
             FROM (SELECT person, name_now FROM affiliations) p
             JOIN (SELECT DISTINCT name_now AS n2, city FROM affiliations) a ON n2 = name_now
             JOIN (SELECT name, state FROM g_city) c ON c.name = a.city"""),
)
def g22(spark, d):
    parts = Parts(spark, d)
    nodes = {
        "Scholar": parts.laureates,
        "Institution": parts.institutions,
        "City": parts.cities,
    }
    affiliations = parts.affiliations
    graph = Graph(
        nodes=nodes,
        keys={label: NODES[label][1] for label in nodes},
        edges={
            "AFFILIATED_WITH": G.affiliated_edges(
                None, affiliations, nodes["Scholar"], nodes["Institution"]
            ).table,
            "IS_LOCATED_IN": G.located_edges(
                None, affiliations, nodes["Institution"], nodes["City"]
            ).table,
        },
        ends={name: EDGES[name][:2] for name in ("AFFILIATED_WITH", "IS_LOCATED_IN")},
    )
    paths = match(
        graph, "Scholar", "s", [Hop("AFFILIATED_WITH", "i"), Hop("IS_LOCATED_IN", "c")]
    )
    return paths.select(
        F.col("s_id").alias("person"),
        F.col("i_name").alias("institution"),
        F.col("c_name").alias("city"),
        F.col("c_state").alias("state"),
    )


def _count(name, text):
    return f"SELECT '{name}' AS name, count(*) AS n FROM ({text})"


@query(
    "p5_graph_tables",
    build(
        " UNION ALL ".join(
            [
                _count("Scholar", "SELECT id FROM g_scholar"),
                _count("Prize", "SELECT id FROM g_prize"),
                _count("City", "SELECT name FROM g_city"),
                _count("Country", "SELECT name FROM g_country"),
                _count("Continent", "SELECT DISTINCT continent FROM affiliations"),
                _count("Institution", "SELECT DISTINCT name_now FROM affiliations"),
                _count("MENTORED", "SELECT src FROM g_mentored"),
                _count("BORN_IN", "SELECT DISTINCT id, city FROM persons"),
                _count("IS_CITY_IN", "SELECT src FROM g_city_in"),
                _count("IS_LOCATED_IN", "SELECT DISTINCT name_now, city FROM affiliations"),
                _count("AFFILIATED_WITH", "SELECT DISTINCT person, name_now FROM affiliations"),
                _count("WON", "SELECT DISTINCT person, prize_id FROM prizes"),
                _count("IS_COUNTRY_IN", "SELECT src FROM g_country_in"),
                "SELECT 'DIED_IN', 0",
            ]
        )
    ),
)
def p5(spark, d):
    folder = GraphFolder(spark, scratch(spark, "graph"))
    tree = materialise(shapes.tree_with_ids(spark, d), "tree")
    ref = materialise(shapes.reference(spark, d), "reference")
    graph, _ = G.build_graph(folder, tree, ref)
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name, df in {**graph.nodes, **graph.edges}.items()
    ]
    total = counts[0]
    for part in counts[1:]:
        total = total.unionByName(part)
    return total
