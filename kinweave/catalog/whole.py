"""Queries for whole stages, the bucketed store and long paths."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave import schemas
from kinweave.catalog import graphs, shapes
from kinweave.catalog.columns import scratch
from kinweave.catalog.registry import SQL, query
from kinweave.catalog.shapes import table
from kinweave.catalog.sql import build
from kinweave.operators.keyed import keyed_reference
from kinweave.operators.paths import Hop, match
from kinweave.operators.reshape import reference_keys
from kinweave.plans import graph as G
from kinweave.plans import stages
from kinweave.session import materialise
from kinweave.sources.records import read_records, write_records
from kinweave.sources.store import KeyedStore
from kinweave.sources.tables import DuplicateKeyError, GraphFolder

# Records of one result page.
PAGE = 25


@query("p1_raw_stage", SQL["f9_reshape_raw"])
def p1(spark, d):
    """Pages of raw records are read, reshaped and written as reference records."""
    pages, target = scratch(spark, "pages"), scratch(spark, "reference")
    raw = shapes.raw(spark, d)
    page = F.floor(F.col("id").cast("long") / PAGE)
    paged = raw.groupBy(page.alias("page")).agg(F.collect_list(F.struct(*raw.columns)).alias("laureates"))
    write_records(paged.select("laureates"), pages, compression="gzip")
    stages.raw_stage(spark, pages, target)
    ref = read_records(spark, target, schemas.REFERENCE)
    sizes = F.aggregate("prizes", F.lit(0), lambda n, p: n + F.size(p["affiliations"]))
    return ref.select(
        "id",
        F.col("fullName").alias("full_name"),
        F.size("prizes").cast("long").alias("n_prizes"),
        sizes.cast("long").alias("n_affiliations"),
    )


REFERENCE_KEYS = """SELECT DISTINCT lower(c_name) || ' ' || lower(category) || ' ' || award_year AS pk,
           CAST(custkey AS VARCHAR) AS id, category, award_year
    FROM prize JOIN customer ON c_custkey = custkey"""
SOURCES = "SELECT name, category FROM entities WHERE type = 'laureate' GROUP BY name, category"


@query("h10_reference_load", build(REFERENCE_KEYS))
def h10(spark, d):
    """The reference half of the keyed load, into the bucketed store."""
    store = KeyedStore(spark, scratch(spark, "store"))
    store.declare("Reference", schemas.KEYED_REFERENCE, "pk")
    rows = keyed_reference(reference_keys(shapes.reference(spark, d)).filter("pk IS NOT NULL"))
    loaded = store.load("Reference", rows)
    return loaded.select("pk", "id", "category", F.col("awardYear").alias("award_year"))


@query(
    "p3_resolution_stage",
    build(
        f"""SELECT 'Scholar' AS name, count(*) AS n FROM ({SOURCES})
            UNION ALL SELECT 'Reference', count(*) FROM ({REFERENCE_KEYS})
            UNION ALL SELECT 'SIMILAR_TO', 3 * count(*) FROM ({SOURCES})
            UNION ALL SELECT 'resolved or rejected', count(*) FROM ({SOURCES})"""
    ),
)
def p3(spark, d):
    """Keys, vectors, index and neighbours are stored, then every source row is judged once."""
    folder = GraphFolder(spark, scratch(spark, "vectors"))
    tree = materialise(shapes.tree(spark, d), "entries")
    ref = materialise(shapes.reference(spark, d), "reference")
    stages.vector_stage(folder, tree, ref, approximate=True)
    done = stages.resolution_stage(folder, approximate=True)
    counted = {name: folder.table(name) for name in ("Scholar", "Reference", "SIMILAR_TO")}
    counted["resolved or rejected"] = done.matched.select("confidence").unionByName(
        done.rejected.select("confidence")
    )
    out = None
    for name, rows in counted.items():
        part = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("p4_merge_stage", SQL["c3_enrich_tree"])
def p4(spark, d):
    """Mapping records and generated ids written into the tree."""
    tree = materialise(shapes.tree(spark, d), "entries")
    done = stages.merge_stage(tree, shapes.mapping(spark, d), "entry_id", "position").tree
    parts = [
        done.select("entry_id", F.lit(g).alias("grp"), F.posexplode(g).alias("pos", "x"))
        for g in ("children", "parents")
    ]
    return (
        parts[0]
        .unionByName(parts[1])
        .select("entry_id", "grp", F.col("pos").cast("long").alias("pos"), "x.name", "x.id")
    )


# The records come in falling order of their ids, and the last one of them wins.
ORDERED = {
    "p_prize": """
        SELECT prize_id AS id, award_year, short AS category, awarded, motivation, amount
        FROM (SELECT *, row_number() OVER (PARTITION BY prize_id ORDER BY custkey, portion DESC,
                     awarded DESC, motivation DESC, amount DESC) AS rk FROM prizes) WHERE rk = 1""",
    "p_birth_city": """
        SELECT city AS name, state FROM (SELECT city, state, row_number() OVER (PARTITION BY city
               ORDER BY c_custkey) AS rk FROM persons) WHERE rk = 1""",
    "p_city": """
        SELECT coalesce(a.name, b.name) AS name,
               CASE WHEN a.name IS NOT NULL THEN a.state ELSE b.state END AS state
        FROM p_birth_city b FULL JOIN g_aff_city a ON a.name = b.name""",
}
# Table: its columns, and the same by SQL.
CONTENTS = {
    "Scholar": (
        ["id", "scholar_type", "name", "fullName", "gender", "birthDate"],
        "SELECT id, scholar_type, name, full_name, gender, birth_date FROM g_scholar",
    ),
    "Prize": (
        ["id", "awardYear", "category", "dateAwarded", "motivation", "prizeAmount"],
        "SELECT id, award_year, category, awarded, motivation, amount FROM p_prize",
    ),
    "City": (["name", "state"], "SELECT name, state FROM p_city"),
    "Country": (["name"], "SELECT name FROM g_country"),
    "Continent": (["name"], "SELECT DISTINCT continent AS name FROM affiliations"),
    "Institution": (["name"], "SELECT DISTINCT name_now AS name FROM affiliations"),
    "MENTORED": (["src", "dst"], "SELECT src, dst FROM g_mentored"),
    "BORN_IN": (["src", "dst"], "SELECT DISTINCT id AS src, city AS dst FROM persons"),
    "IS_CITY_IN": (["src", "dst"], "SELECT src, dst FROM g_city_in"),
    "IS_LOCATED_IN": (["src", "dst"], "SELECT DISTINCT name_now AS src, city AS dst FROM affiliations"),
    "AFFILIATED_WITH": (["src", "dst"], "SELECT DISTINCT person AS src, name_now AS dst FROM affiliations"),
    "WON": (
        ["src", "dst", "portion"],
        "SELECT person AS src, prize_id AS dst, max(portion) AS portion FROM prizes GROUP BY ALL",
    ),
    "IS_COUNTRY_IN": (["src", "dst"], "SELECT src, dst FROM g_country_in"),
}


def _sql_cells(text: str, columns: list[str]) -> str:
    listed = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns)
    return f"SELECT list_value({listed}) AS cells FROM ({text})"


def _table_sql(name: str, columns: list[str], text: str) -> str:
    return f"""SELECT '{name}' AS name, count(*) AS n,
               CAST(coalesce(sum(CAST('0x' || substr(md5(array_to_string(cells, '|')), 1, 8) AS BIGINT)), 0)
                 AS BIGINT) AS checksum
        FROM ({_sql_cells(text, columns)})"""


def _names(text: str) -> list[str]:
    """Columns of a SELECT by their aliases."""
    listed = text.split(" FROM ", 1)[0].removeprefix("SELECT ").removeprefix("DISTINCT ")
    return [part.split(" AS ")[-1].strip() for part in listed.split(", ")]


@query(
    "p5_graph_contents",
    build(
        " UNION ALL ".join(
            _table_sql(name, _names(text), text) for name, (_, text) in CONTENTS.items()
        ),
        ORDERED,
    ),
)
def p5_contents(spark, d):
    """Rows and a checksum of every table of the graph, with the records in a given order."""
    folder = GraphFolder(spark, scratch(spark, "graph"))
    tree = materialise(shapes.tree_with_ids(spark, d), "tree")
    ref = shapes.reference(spark, d).withColumn("position", -F.col("id").cast("long"))
    graph, _ = G.build_graph(folder, tree, materialise(ref, "reference"), "position")
    out = None
    for name, (columns, _) in CONTENTS.items():
        rows = {**graph.nodes, **graph.edges}[name]
        cells = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
        number = F.conv(F.substring(F.md5(cells.cast("binary")), 1, 8), 16, 10).cast("long")
        part = rows.agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(number), F.lit(0)).alias("checksum")
        ).select(F.lit(name).alias("name"), "n", "checksum")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "g22_three_hop",
    build("""SELECT g_prize.id AS prize, w.person, w.portion, a.name_now AS institution, l.city
             FROM g_prize JOIN (SELECT person, prize_id, max(portion) AS portion FROM prizes GROUP BY ALL) w
               ON w.prize_id = g_prize.id AND category = 'physics' AND w.portion >= '1/3'
             JOIN persons p ON p.id = w.person AND contains(p.name, '7')
             JOIN (SELECT DISTINCT person, name_now FROM affiliations) a ON a.person = w.person
             JOIN (SELECT DISTINCT name_now, city FROM affiliations) l ON l.name_now = a.name_now
             JOIN g_city c ON c.name = l.city AND c.state IS NOT NULL"""),
)
def g22_three(spark, d):
    """Winners of physics prizes, their institutions and cities; conditions on nodes and edges."""
    parts = graphs.Parts(spark, d)
    affiliations, prizes = parts.affiliations, parts.prizes
    nodes = {
        "Prize": G.prize_nodes(None, prizes).table,
        "Scholar": parts.laureates,
        "Institution": parts.institutions,
        "City": parts.cities,
    }
    edges = {
        "WON": G.won_edges(None, prizes, nodes["Scholar"], nodes["Prize"]).table,
        "AFFILIATED_WITH": G.affiliated_edges(
            None, affiliations, nodes["Scholar"], nodes["Institution"]
        ).table,
        "IS_LOCATED_IN": G.located_edges(None, affiliations, nodes["Institution"], nodes["City"]).table,
    }
    graph = graphs.Graph(
        nodes=nodes,
        keys={label: schemas.NODES[label][1] for label in nodes},
        edges=edges,
        ends={name: schemas.EDGES[name][:2] for name in edges},
    )
    hops = [
        Hop("WON", "s", "in", F.col("name").contains("7"), edge_where="portion >= '1/3'"),
        Hop("AFFILIATED_WITH", "i"),
        Hop("IS_LOCATED_IN", "c", where="state IS NOT NULL"),
    ]
    paths = match(graph, "Prize", "p", hops, "category = 'physics'", reduce=True)
    return paths.select(
        F.col("p_id").alias("prize"),
        F.col("s_id").alias("person"),
        F.col("won_portion").alias("portion"),
        F.col("i_name").alias("institution"),
        F.col("c_name").alias("city"),
    )


@query("g1_store_merge", SQL["g1_merge_nodes"])
def g1_store(spark, d):
    """The same upsert in the bucketed store, in the buckets of the batch alone."""
    schema = T.StructType()
    for name, kind in (("id", "long"), ("name", "string"), ("status", "string"), ("note", "string")):
        schema = schema.add(name, kind)
    store = KeyedStore(spark, scratch(spark, "store"))
    store.declare("Customer", schema, "id")
    store.load(
        "Customer",
        table(spark, d, "customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.lit("none").alias("status"),
            F.col("c_mktsegment").alias("note"),
        ),
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
    return store.merge("Customer", incoming, ["status", "note"], F.struct("o_orderdate", "o_orderkey"))


@query("a4_store_load", "SELECT c_name AS name, c_mktsegment AS segment, 1 AS n_refused FROM customer")
def a4_store(spark, d):
    """Two loads with different keys, and a third that is refused and changes nothing."""
    schema = T.StructType().add("name", "string").add("segment", "string")
    store = KeyedStore(spark, scratch(spark, "store"))
    store.declare("Person", schema, "name")
    rows = table(spark, d, "customer").select(
        F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"), "c_acctbal"
    )
    store.load("Person", rows.filter("c_acctbal < 0"))
    store.load("Person", rows.filter("c_acctbal >= 0"))
    refused = 0
    try:
        store.load("Person", rows)
    except DuplicateKeyError:
        refused = 1
    return store.table("Person").withColumn("n_refused", F.lit(refused))
