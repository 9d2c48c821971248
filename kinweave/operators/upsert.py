"""Upserts of node and edge tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.operators.keys import last_wins


class Merged(NamedTuple):
    """``table`` is the new table. ``counts`` has one row: ``rows_matched`` (input rows
    that reached the table, repeats included) and ``distinct_count``."""

    table: DataFrame
    counts: DataFrame


def _order(order: Column | str | None, columns: list[str]) -> Column:
    """The given order, or else the values themselves, so a result is never arbitrary."""
    if order is None:
        return F.struct(*columns) if columns else F.lit(1)
    return F.col(order) if isinstance(order, str) else order


def merge_nodes(
    existing: DataFrame | None,
    incoming: DataFrame,
    key: str,
    set_cols: list[str],
    order: Column | str | None = None,
) -> Merged:
    """Create or update nodes by key.

    ``set_cols`` overwrite what is stored, also with NULL; other stored columns stay.
    Of several rows with one key the last in ``order`` wins. Rows without a key are
    not nodes and are left out. The batch is reduced to a row per key before the join,
    so both sides of the join are unique on its key.
    """
    rows = incoming.filter(F.col(key).isNotNull())
    counts = rows.agg(
        F.count(F.lit(1)).alias("rows_matched"), F.count_distinct(key).alias("distinct_count")
    )
    batch = last_wins(rows, [key], set_cols, _order(order, set_cols))
    if existing is None:
        return Merged(batch, counts)
    new = batch.select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in set_cols]
    )
    joined = existing.join(new, existing[key] == new["_key"], "full_outer")
    columns = [F.coalesce(existing[key], F.col("_key")).alias(key)]
    for name in existing.columns:
        if name == key:
            continue
        if name in set_cols:
            columns.append(
                F.when(F.col("_key").isNotNull(), F.col(f"_new_{name}"))
                .otherwise(existing[name])
                .alias(name)
            )
        else:
            columns.append(existing[name])
    return Merged(joined.select(*columns).select(*existing.columns), counts)


def _has_endpoint(edges: DataFrame, column: str, nodes: DataFrame, key: str) -> DataFrame:
    keys = nodes.select(F.col(key).alias("_node"))
    return edges.join(keys, F.col(column) == F.col("_node"), "left_semi")


def match_endpoints(
    edges: DataFrame,
    src_nodes: DataFrame,
    src_key: str,
    dst_nodes: DataFrame,
    dst_key: str,
) -> DataFrame:
    """Edges whose two endpoints exist. Node keys are unique, so no row is repeated.

    Node tables should be stored tables: then both inputs of a join are plain shuffles,
    and one that holds a node of very many edges is split by adaptive execution.
    """
    return _has_endpoint(
        _has_endpoint(edges, "src", src_nodes, src_key), "dst", dst_nodes, dst_key
    )


def orphan_edges(
    edges: DataFrame,
    src_nodes: DataFrame,
    src_key: str,
    dst_nodes: DataFrame,
    dst_key: str,
) -> DataFrame:
    """Distinct edges that a merge drops because an endpoint is missing."""
    distinct = edges.select("src", "dst").distinct()
    matched = match_endpoints(distinct, src_nodes, src_key, dst_nodes, dst_key)
    return distinct.join(
        matched.select(F.col("src").alias("_s"), F.col("dst").alias("_d")),
        F.col("src").eqNullSafe(F.col("_s")) & F.col("dst").eqNullSafe(F.col("_d")),
        "left_anti",
    )


def merge_edges(
    existing: DataFrame | None,
    incoming: DataFrame,
    src_nodes: DataFrame,
    src_key: str,
    dst_nodes: DataFrame,
    dst_key: str,
    set_cols: list[str] | None = None,
    order: Column | str | None = None,
    weight: str | None = None,
) -> Merged:
    """Create edges between existing nodes, or update their properties.

    ``incoming`` has ``src``, ``dst`` and the properties. Repeats of an edge are
    combined map-side before the endpoints are matched; ``weight`` is the number of
    input rows a row stands for.
    """
    set_cols = set_cols or []
    n_rows = F.sum(weight) if weight else F.count(F.lit(1))
    best = F.max_by(
        F.struct(*set_cols) if set_cols else F.lit(1), F.struct(_order(order, set_cols))
    ).alias("_best")
    grouped = (
        incoming.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
        .groupBy("src", "dst")
        .agg(n_rows.alias("_rows"), *([best] if set_cols else []))
    )
    matched = match_endpoints(grouped, src_nodes, src_key, dst_nodes, dst_key)
    counts = matched.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_matched"),
        F.count(F.lit(1)).alias("distinct_count"),
    )
    batch = matched.select(
        F.col("src").alias("_src"),
        F.col("dst").alias("_dst"),
        *[F.col(f"_best.{c}").alias(f"_new_{c}") for c in set_cols],
    )
    if existing is None:
        renamed = batch.select(
            F.col("_src").alias("src"),
            F.col("_dst").alias("dst"),
            *[F.col(f"_new_{c}").alias(c) for c in set_cols],
        )
        return Merged(renamed, counts)
    joined = existing.join(
        batch,
        (existing["src"] == batch["_src"]) & (existing["dst"] == batch["_dst"]),
        "full_outer",
    )
    columns = [
        F.coalesce(existing["src"], F.col("_src")).alias("src"),
        F.coalesce(existing["dst"], F.col("_dst")).alias("dst"),
    ]
    for name in existing.columns:
        if name in ("src", "dst"):
            continue
        if name in set_cols:
            columns.append(
                F.when(F.col("_src").isNotNull(), F.col(f"_new_{name}"))
                .otherwise(existing[name])
                .alias(name)
            )
        else:
            columns.append(existing[name])
    return Merged(joined.select(*columns), counts)
