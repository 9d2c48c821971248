"""The five batch stages, from raw pages to the graph."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave import schemas
from kinweave.operators.approximate import (
    VectorIndex,
    approximate_topk,
    build_vector_index,
    open_vector_index,
)
from kinweave.operators.embed import Embedder, embed, hashed_ngrams
from kinweave.operators.keyed import keyed_reference, keyed_source
from kinweave.operators.keys import key_collisions, top_k_per_group
from kinweave.operators.neighbours import similar_edges, topk_similarity
from kinweave.operators.nested import enrich_tree, laureate_lookup, scholar_lookup
from kinweave.operators.numbering import slice_rows
from kinweave.operators.paths import Graph
from kinweave.operators.reshape import (
    EXCLUDED_CATEGORIES,
    entity_ids,
    laureate_keys,
    reference_keys,
    reshape_raw,
)
from kinweave.operators.resolve import (
    Judge,
    Resolved,
    candidates,
    judge_by_function,
    judge_by_score,
    name_score,
    resolve,
)
from kinweave.operators.upsert import merge_edges
from kinweave.plans.graph import build_graph
from kinweave.session import materialise
from kinweave.sources.records import assemble_pages, write_records
from kinweave.sources.tables import GraphFolder


def raw_stage(
    spark: SparkSession,
    pages: str,
    target: str,
    excluded: list[str] = EXCLUDED_CATEGORIES,
    mode: str = "per_prize",
    layout: str = "lines",
    compression: str | None = "gzip",
) -> None:
    """Pages of raw records to reference records.

    ``per_prize`` writes a record once for each of its prizes, with all of them in it; such
    copies follow each other and are packed to little more than one of them.
    """
    raw = assemble_pages(spark, pages, schemas.RAW_PAGE, "laureates", layout)
    write_records(reshape_raw(raw, excluded, mode), target, compression=compression)


def declare_vectors(folder: GraphFolder) -> None:
    folder.declare_node("Scholar", schemas.KEYED_SOURCE, "pk")
    folder.declare_node("Reference", schemas.KEYED_REFERENCE, "pk")
    src, dst, props = schemas.SIMILAR_TO
    folder.declare_edge("SIMILAR_TO", src, dst, props)


def _index_path(folder: GraphFolder) -> str:
    return f"{folder.root}/_index"


def stored_index(folder: GraphFolder) -> VectorIndex:
    """The index beside the tables; built and stored if the vector stage made none."""
    spark, path = folder.spark, _index_path(folder)
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/settings/_SUCCESS")
    if done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        return open_vector_index(spark, path)
    return build_vector_index(folder.table("Reference"), id_col="pk", path=path)


def vector_stage(
    folder: GraphFolder,
    tree: DataFrame,
    ref: DataFrame,
    embedder: Embedder = hashed_ngrams,
    k: int = 3,
    approximate: bool = False,
) -> None:
    """Key, embed and load both sources, then store the ``k`` nearest reference rows of
    each source row as SIMILAR_TO edges. The approximate index is stored beside the tables.

    The rows that stay are chosen and stored before they get their vectors, which depend on the
    text of a row alone: no vector of a row that goes is made, joined or sorted."""
    declare_vectors(folder)
    for name in ("Scholar", "Reference", "SIMILAR_TO"):
        folder.reset(name)
    # A source row's vector is that of its longer key, with the year.
    kept = keyed_source(laureate_keys(tree).withColumn("_text", F.col("pk")))
    kept = materialise(kept, "source-rows")
    source = folder.load_nodes(embed(kept, "_text", embedder), "Scholar")
    records = keyed_reference(reference_keys(ref).filter("pk IS NOT NULL"))
    records = materialise(records, "reference-rows")
    reference = folder.load_nodes(
        embed(records, "pk", embedder), "Reference", schemas.KEYED_REFERENCE.fieldNames()
    )
    if approximate:
        index = build_vector_index(reference, id_col="pk", path=_index_path(folder))
        found = approximate_topk(source, index, k, left_id="pk")
    else:
        found = topk_similarity(source, reference, k, left_id="pk", right_id="pk")
    near = similar_edges(found)
    merged = merge_edges(
        folder.table("SIMILAR_TO"), near, source, "pk", reference, "pk", ["similarity_score"]
    )
    folder.replace("SIMILAR_TO", merged.table)


def stored_neighbours(folder: GraphFolder, chosen: DataFrame, k: int) -> DataFrame:
    """The ``k`` best stored edges of the chosen rows, as a search would return them."""
    edges = folder.table("SIMILAR_TO").select(
        F.col("src").alias("source_id"),
        F.col("dst").alias("target_id"),
        F.col("similarity_score").cast("double").alias("score"),
    )
    own = edges.join(chosen.select(F.col("pk").alias("source_id")), "source_id", "left_semi")
    return top_k_per_group(own, ["source_id"], [F.col("score").desc(), "target_id"], k)


RECORD = ["id", "knownName", "fullName", "category"]


def resolution_stage(
    folder: GraphFolder,
    judge: Judge | None = None,
    score: Callable[[Column], Column] | None = None,
    k: int = 3,
    start: int = 0,
    end: int | None = None,
    seed: int | None = 0,
    approximate: bool = False,
    concurrency: int = 1,
) -> Resolved:
    """Choose one reference person per source row, as mapping records.

    ``judge`` is an outside function, ``score`` a column expression on a candidate;
    without either the built-in name score decides. Candidates come from the SIMILAR_TO edges
    of the vector stage, or with ``approximate`` from the index it stored; nothing is searched
    or built again. Rows are put in order only for a slice.
    """
    chosen = folder.table("Scholar")
    if start or end is not None:
        chosen = slice_rows(chosen, ["name", "pk"], start, end)
    reference = folder.table("Reference")
    if approximate:
        near = approximate_topk(chosen, stored_index(folder), k, left_id="pk")
    else:
        near = stored_neighbours(folder, chosen, k)
    lists = candidates(
        near,
        reference.withColumn("id", F.col("id").cast("long")),
        "pk",
        RECORD,
        seed=seed,
    )
    rows = (
        chosen.select("pk", "name", "category", "year")
        .join(lists, F.col("pk") == F.col("source_id"), "left")
        .drop("source_id")
    )
    if judge is not None:
        judged = judge_by_function(
            rows, judge, sample=["name", "category"], concurrency=concurrency
        )
    else:
        judged = judge_by_score(
            rows, score or (lambda c: name_score(F.col("name"), F.col("category"), c))
        )
        judged = materialise(judged, "judged")
    return resolve(judged, source=["name", "category", "year"])


class Enriched(NamedTuple):
    tree: DataFrame
    collisions: DataFrame  # names that stand for several ids and were collapsed


def merge_stage(
    tree: DataFrame, mapping: DataFrame, entry_id: str | None = None, order_col: str | None = None
) -> Enriched:
    """Ids of the mapping records and generated scholar ids, written into the tree."""
    ids = entity_ids(tree)
    if order_col is None:
        mapping, order_col = mapping.withColumn("_order", F.col("matched_record.id")), "_order"
    lookup = laureate_lookup(mapping, order_col).unionByName(
        scholar_lookup(ids.withColumn("_n", F.expr("cast(substr(id, 2) as long)")), "_n")
    )
    named = mapping.select(
        F.lit("laureate").alias("type"),
        F.col("source.name").alias("name"),
        F.concat(F.lit("l"), F.col("matched_record.id").cast("string")).alias("id"),
    ).unionByName(ids.select("type", "name", "id"))
    return Enriched(
        enrich_tree(tree, lookup, entry_id), key_collisions(named, ["type", "name"], "id")
    )


def graph_stage(
    folder: GraphFolder, tree: DataFrame, ref: DataFrame, order: str | None = None
) -> tuple[Graph, dict[str, DataFrame]]:
    """The enriched property graph and the counters of its steps; see :func:`build_graph`."""
    return build_graph(folder, tree, ref, order)
