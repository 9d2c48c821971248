"""The property graph: which frame fills which node and edge table.

Every function takes the stored table (or None) and returns the merged one with its
counters. Nodes come before the edges that need them, and birth cities before
affiliation cities, whose state overwrites theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions.columns import kind_from_id
from kinweave.operators.paths import Graph
from kinweave.operators.reshape import (
    affiliations_frame,
    mentor_pairs,
    persons_frame,
    prizes_frame,
    stack_entities,
)
from kinweave.operators.upsert import Merged, merge_edges, merge_nodes
from kinweave.schemas import EDGES, NODES
from kinweave.session import materialise
from kinweave.sources.tables import GraphFolder, conform


def _present(df: DataFrame, *columns: str) -> DataFrame:
    for name in columns:
        df = df.filter(F.col(name).isNotNull())
    return df


def _nodes(
    label: str,
    existing: DataFrame | None,
    rows: DataFrame,
    set_cols: list[str],
    order: Column | str | None = None,
) -> Merged:
    schema, key = NODES[label]
    merged = merge_nodes(existing, rows, key, set_cols, order)
    return Merged(conform(merged.table, schema), merged.counts)


def _edges(
    name: str,
    existing: DataFrame | None,
    rows: DataFrame,
    src_nodes: DataFrame,
    dst_nodes: DataFrame,
    order: Column | str | None = None,
    weight: str | None = None,
) -> Merged:
    src, dst, props = EDGES[name]
    return merge_edges(
        existing, rows, src_nodes, NODES[src][1], dst_nodes, NODES[dst][1], list(props), order, weight
    )


# --- nodes ---


def person_nodes(
    existing: DataFrame | None, persons: DataFrame, order: str | None = None
) -> Merged:
    """A person of several records keeps the values of the last in ``order``, by default the
    order of the values."""
    values = ["id", "knownName", "fullName", "gender", "birthDate", "deathDate"]
    rows = persons.select(*values).distinct()
    if order is not None:  # equal rows count once, at their last place
        rows = persons.groupBy(*values).agg(F.max(order).alias(order))
    rows = rows.withColumn("name", F.col("knownName")).withColumn(
        "scholar_type", kind_from_id(F.col("id"))
    )
    columns = [c for c in NODES["Scholar"][0].fieldNames() if c != "id"]
    by = None if order is None else F.struct(order, *columns)
    return _nodes("Scholar", existing, rows, columns, by)


def scholar_nodes(existing: DataFrame | None, entities: DataFrame) -> Merged:
    rows = entities.filter(F.col("type") == "scholar").select(
        "id", "name", F.lit("scholar").alias("scholar_type")
    )
    return _nodes("Scholar", existing, rows, ["scholar_type", "name"])


def prize_nodes(
    existing: DataFrame | None, prizes: DataFrame, order: Column | str | None = None
) -> Merged:
    """A shared prize keeps the values of one of its winners: the last in ``order``, by
    default the order of person id and values."""
    columns = [c for c in NODES["Prize"][0].fieldNames() if c != "id"]
    rows = prizes.withColumn("id", F.col("prize_id"))
    return _nodes(
        "Prize", existing, rows, columns, F.struct("laureate_id", *columns) if order is None else order
    )


def birth_city_nodes(
    existing: DataFrame | None, persons: DataFrame, order: str | None = None
) -> Merged:
    """A city keeps the state of its last person, by default in the order of their ids."""
    by = [*([order] if order else []), "id"]
    rows = _present(persons, "birthPlaceCity").select(
        F.col("birthPlaceCity").alias("name"), F.col("birthPlaceState").alias("state"), *by
    )
    return _nodes("City", existing, rows, ["state"], F.struct(*by, "state"))


def birth_country_nodes(existing: DataFrame | None, persons: DataFrame) -> Merged:
    rows = persons.select(F.col("birthPlaceCountryNow").alias("name"))
    return _nodes("Country", existing, rows, [])


def institution_nodes(existing: DataFrame | None, affiliations: DataFrame) -> Merged:
    rows = affiliations.select(F.col("nameNow").alias("name"))
    return _nodes("Institution", existing, rows, [])


def affiliation_city_nodes(existing: DataFrame | None, affiliations: DataFrame) -> Merged:
    rows = affiliations.select(
        F.col("cityNow").alias("name"), F.col("stateNow").alias("state")
    ).distinct()
    return _nodes("City", existing, rows, ["state"], "state")


def continent_nodes(existing: DataFrame | None, affiliations: DataFrame) -> Merged:
    rows = affiliations.select(F.col("continent").alias("name")).distinct()
    return _nodes("Continent", existing, rows, [])


# --- edges ---


def mentored_edges(existing: DataFrame | None, tree: DataFrame, scholars: DataFrame) -> Merged:
    pairs = mentor_pairs(tree, weighted=True).select(
        F.col("parent_id").alias("src"), F.col("child_id").alias("dst"), "n_rows"
    )
    return _edges("MENTORED", existing, pairs, scholars, scholars, weight="n_rows")


def _ends(df: DataFrame, src: str, dst: str, *props: str) -> DataFrame:
    return df.select(F.col(src).alias("src"), F.col(dst).alias("dst"), *props)


def born_in_edges(
    existing: DataFrame | None, persons: DataFrame, scholars: DataFrame, cities: DataFrame
) -> Merged:
    rows = _ends(_present(persons, "birthPlaceCity"), "id", "birthPlaceCity")
    return _edges("BORN_IN", existing, rows, scholars, cities)


def birth_city_country_edges(
    existing: DataFrame | None, persons: DataFrame, cities: DataFrame, countries: DataFrame
) -> Merged:
    # The historic city together with the present country.
    rows = _present(persons, "birthPlaceCity", "birthPlaceCountryNow")
    rows = _ends(rows, "birthPlaceCity", "birthPlaceCountryNow")
    return _edges("IS_CITY_IN", existing, rows, cities, countries)


def won_edges(
    existing: DataFrame | None,
    prizes: DataFrame,
    scholars: DataFrame,
    prize_table: DataFrame,
    order: Column | str | None = None,
) -> Merged:
    rows = prizes.withColumn("src", F.col("laureate_id")).withColumn("dst", F.col("prize_id"))
    return _edges("WON", existing, rows, scholars, prize_table, order)


def affiliated_edges(
    existing: DataFrame | None,
    affiliations: DataFrame,
    scholars: DataFrame,
    institutions: DataFrame,
) -> Merged:
    rows = _ends(_present(affiliations, "nameNow"), "laureateID", "nameNow")
    return _edges("AFFILIATED_WITH", existing, rows, scholars, institutions)


def located_edges(
    existing: DataFrame | None,
    affiliations: DataFrame,
    institutions: DataFrame,
    cities: DataFrame,
) -> Merged:
    rows = _ends(_present(affiliations, "cityNow", "nameNow"), "nameNow", "cityNow")
    return _edges("IS_LOCATED_IN", existing, rows, institutions, cities)


def affiliation_city_country_edges(
    existing: DataFrame | None, affiliations: DataFrame, cities: DataFrame, countries: DataFrame
) -> Merged:
    rows = _ends(_present(affiliations, "cityNow", "countryNow"), "cityNow", "countryNow")
    return _edges("IS_CITY_IN", existing, rows, cities, countries)


def country_continent_edges(
    existing: DataFrame | None,
    affiliations: DataFrame,
    countries: DataFrame,
    continents: DataFrame,
) -> Merged:
    rows = _ends(_present(affiliations, "countryNow", "continent"), "countryNow", "continent")
    return _edges("IS_COUNTRY_IN", existing, rows, countries, continents)


# --- the whole graph ---


def declare_graph(folder: GraphFolder) -> None:
    for label, (schema, key) in NODES.items():
        folder.declare_node(label, schema, key)
    for name, (src, dst, props) in EDGES.items():
        folder.declare_edge(name, src, dst, props)


def open_graph(folder: GraphFolder) -> Graph:
    """The stored tables as a graph to match patterns on."""
    return Graph(
        nodes={label: folder.table(label) for label in folder.nodes},
        keys={label: spec.key for label, spec in folder.nodes.items()},
        edges={name: folder.table(name) for name in folder.edges},
        ends={name: (spec.src, spec.dst) for name, spec in folder.edges.items()},
    )


def build_graph(
    folder: GraphFolder, tree: DataFrame, ref: DataFrame, order: str | None = None
) -> tuple[Graph, dict[str, DataFrame]]:
    """Fill a fresh graph from the enriched tree and the reference records.

    Each table is written once and later steps read it back; the three frames that feed
    several tables are written once as well. ``order`` is a column of ``ref`` with the place
    of a record in its source: of records that set the same node or edge the last one wins.
    Without it the greatest values win. Returns the graph and the counters by step.
    """
    declare_graph(folder)
    folder.reset("DIED_IN")  # no step fills it; all other tables are replaced below
    keep = [order] if order else []
    persons = materialise(persons_frame(ref, keep=keep), "persons")
    prizes = materialise(prizes_frame(ref, keep), "prizes")
    affiliations = materialise(affiliations_frame(ref), "affiliations")
    entities = stack_entities(tree, sort=False)
    counts: dict[str, DataFrame] = {}

    def store(step: str, name: str, merged: Merged) -> DataFrame:
        counts[step] = merged.counts
        return folder.replace(name, merged.table)

    rest = [c for c in prizes.columns if c != order]
    by = F.struct(order, *rest) if order else None
    people = store("persons", "Scholar", person_nodes(None, persons, order))
    prize_table = store("prizes", "Prize", prize_nodes(None, prizes, by))
    people = store("scholars", "Scholar", scholar_nodes(people, entities))
    cities = store("birth cities", "City", birth_city_nodes(None, persons, order))
    countries = store("countries", "Country", birth_country_nodes(None, persons))
    institutions = store("institutions", "Institution", institution_nodes(None, affiliations))
    cities = store("affiliation cities", "City", affiliation_city_nodes(cities, affiliations))
    continents = store("continents", "Continent", continent_nodes(None, affiliations))

    store("born in", "BORN_IN", born_in_edges(None, persons, people, cities))
    in_country = store(
        "birth city in country",
        "IS_CITY_IN",
        birth_city_country_edges(None, persons, cities, countries),
    )
    store("mentored", "MENTORED", mentored_edges(None, tree, people))
    store("won", "WON", won_edges(None, prizes, people, prize_table, by))
    store(
        "affiliated", "AFFILIATED_WITH", affiliated_edges(None, affiliations, people, institutions)
    )
    store(
        "country in continent",
        "IS_COUNTRY_IN",
        country_continent_edges(None, affiliations, countries, continents),
    )
    store("located in", "IS_LOCATED_IN", located_edges(None, affiliations, institutions, cities))
    store(
        "affiliation city in country",
        "IS_CITY_IN",
        affiliation_city_country_edges(in_country, affiliations, cities, countries),
    )
    return open_graph(folder), counts
