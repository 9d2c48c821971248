"""Path patterns over node and edge tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions.columns import contains_any
from kinweave.session import materialise


@dataclass(frozen=True)
class Graph:
    """Node tables by label with their keys, edge tables by name with their ends."""

    nodes: dict[str, DataFrame]
    keys: dict[str, str]
    edges: dict[str, DataFrame]
    ends: dict[str, tuple[str, str]]


@dataclass(frozen=True)
class Hop:
    """One step: ``out`` follows an edge from src to dst, ``in`` the other way.

    ``where`` is a condition on the node that is reached, ``edge_where`` on the edge's columns.
    """

    edge: str
    alias: str
    direction: str = "out"
    where: str | Column | None = None
    edge_alias: str | None = None
    edge_where: str | Column | None = None


def _node(graph: Graph, label: str, alias: str, where: str | Column | None) -> DataFrame:
    nodes = graph.nodes[label]
    if where is not None:
        nodes = nodes.filter(where)
    return nodes.select(*[F.col(c).alias(f"{alias}_{c}") for c in nodes.columns])


def _steps(graph: Graph, label: str, hops: list[Hop]) -> list[tuple[DataFrame, str]]:
    """(_near, _far and properties) of each hop's edges, and the label it reaches."""
    steps, current = [], label
    for hop in hops:
        src, dst = graph.ends[hop.edge]
        near, far, begin, target = (
            ("src", "dst", src, dst) if hop.direction == "out" else ("dst", "src", dst, src)
        )
        if begin != current:
            raise ValueError(f"{hop.edge} does not start at {current}")
        edges = graph.edges[hop.edge]
        if hop.edge_where is not None:
            edges = edges.filter(hop.edge_where)
        prefix = hop.edge_alias or hop.edge.lower()
        edges = edges.select(
            F.col(near).alias("_near"),
            F.col(far).alias("_far"),
            *[F.col(c).alias(f"{prefix}_{c}") for c in edges.columns if c not in ("src", "dst")],
        )
        steps.append((edges, target))
        current = target
    return steps


def match(
    graph: Graph,
    label: str,
    alias: str,
    hops: list[Hop],
    where: str | Column | None = None,
    reduce: bool = False,
) -> DataFrame:
    """Rows of all paths that start at ``label`` and follow ``hops``.

    Node columns come out as ``<alias>_<column>``. A node condition filters the node
    table before its join, and columns not used later are pruned from the scans. With
    ``reduce`` the edges that are on no whole path go first, see :func:`_reduced`.
    """
    steps = _steps(graph, label, hops)
    if reduce and hops:
        return _reduced(graph, label, alias, hops, where, steps)
    current, current_alias = label, alias
    paths = _node(graph, label, alias, where)
    for hop, (edges, target) in zip(hops, steps):
        nodes = _node(graph, target, hop.alias, hop.where)
        paths = (
            paths.join(
                edges, F.col(f"{current_alias}_{graph.keys[current]}") == F.col("_near")
            )
            .drop("_near")
            .join(nodes, F.col("_far") == F.col(f"{hop.alias}_{graph.keys[target]}"))
            .drop("_far")
        )
        current, current_alias = target, hop.alias
    return paths


def _within(edges: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """The edges whose end is among the keys, a frame of one column."""
    only = keys.toDF("_key")
    return edges.join(only, F.col(column) == F.col("_key"), "left_semi")


def reduced_edges(
    graph: Graph, label: str, hops: list[Hop], where: str | Column | None = None
) -> list[DataFrame]:
    """Of each hop the edges that are on a whole path, with all conditions.

    First from the start: edges that begin where the hop before can end and lead to a node
    that is wanted. Then from the end: edges that lead to where the hop after begins. No path
    row is built; each result is stored, so its size is known.
    """
    steps = _steps(graph, label, hops)
    nodes = graph.nodes[label]
    alive = (nodes if where is None else nodes.filter(where)).select(graph.keys[label])
    kept: list[DataFrame] = []
    for hop, (edges, target) in zip(hops, steps):
        goals = graph.nodes[target]
        goals = goals if hop.where is None else goals.filter(hop.where)
        links = _within(_within(edges, "_near", alive), "_far", goals.select(graph.keys[target]))
        kept.append(materialise(links, "path-links"))
        alive = kept[-1].select("_far").distinct()
    for i in range(len(kept) - 2, -1, -1):
        after = kept[i + 1].select("_near").distinct()
        kept[i] = materialise(_within(kept[i], "_far", after), "path-links")
    return kept


def _reduced(
    graph: Graph, label: str, alias: str, hops: list[Hop], where: str | Column | None, steps: list
) -> DataFrame:
    """Paths from reduced edges, joined from the smallest hop outwards.

    Each edge that is left is on a whole path, so a row of a partial path never comes to
    nothing: no intermediate result has more rows than the answer. Of the two neighbours of
    what is joined so far the smaller one comes next.
    """
    links = reduced_edges(graph, label, hops, where)
    sizes = [part.count() for part in links]
    named = [
        part.withColumnsRenamed({"_near": f"_n{i}", "_far": f"_n{i + 1}"})
        for i, part in enumerate(links)
    ]
    first = sizes.index(min(sizes))
    low, high, paths = first, first, named[first]
    while low > 0 or high < len(named) - 1:
        down = sizes[low - 1] if low > 0 else None
        up = sizes[high + 1] if high < len(named) - 1 else None
        if up is None or (down is not None and down <= up):
            low -= 1
            paths = paths.join(named[low], f"_n{low + 1}")
        else:
            high += 1
            paths = paths.join(named[high], f"_n{high}")
    stops = [(label, alias), *((target, hop.alias) for hop, (_, target) in zip(hops, steps))]
    props: list[str] = []
    for part in links:
        props += [c for c in part.columns if c not in ("_near", "_far")]
    columns: list[str] = []
    for i, (target, name) in enumerate(stops):
        nodes = _node(graph, target, name, None)
        paths = paths.join(nodes, F.col(f"_n{i}") == F.col(f"{name}_{graph.keys[target]}"))
        columns += nodes.columns
    return paths.select(*columns, *props)


def incoming_counts(
    graph: Graph, edge: str, name_col: str, needles: list[str], count_col: str
) -> DataFrame:
    """Number of incoming edges of the nodes whose name holds one of the needles.

    Edges are counted per target before they meet the nodes, so a target with very
    many edges arrives at the join as one row. Edge tables hold no dangling ends, which
    makes a look at the source nodes unnecessary.
    """
    _, label = graph.ends[edge]
    nodes = graph.nodes[label].filter(contains_any(F.col(name_col), *needles))
    per_node = graph.edges[edge].groupBy("dst").agg(F.count(F.lit(1)).alias("_n"))
    return (
        nodes.select(F.col(graph.keys[label]).alias("_key"), name_col)
        .join(per_node, F.col("_key") == F.col("dst"))
        .groupBy(name_col)
        .agg(F.sum("_n").alias(count_col))
    )


def lookup(
    nodes: DataFrame, text_col: str, needles: list[str], columns: list[str], order: list[str]
) -> DataFrame:
    """Nodes whose text holds one of the needles, projected and sorted."""
    return nodes.filter(contains_any(F.col(text_col), *needles)).select(*columns).orderBy(*order)
