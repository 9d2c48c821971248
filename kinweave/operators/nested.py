"""Writing resolved ids back into nested tree entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.operators.keys import last_wins
from kinweave.session import materialise

GROUPS = ("children", "parents")


def laureate_lookup(mapping: DataFrame, order_col: str) -> DataFrame:
    """(type, name, id) from mapping records; of equal names the last entry wins."""
    rows = mapping.select(
        F.lit("laureate").alias("type"),
        F.col("source.name").alias("name"),
        F.concat(F.lit("l"), F.col("matched_record.id").cast("string")).alias("id"),
        F.col(order_col).alias("_order"),
    )
    return last_wins(rows, ["type", "name"], ["id"], "_order")


def scholar_lookup(ids: DataFrame, order_col: str = "id") -> DataFrame:
    """(type, name, id) from generated ids; of equal names the last one wins."""
    rows = ids.select(
        F.lit("scholar").alias("type"), "name", F.col("id"), F.col(order_col).alias("_order")
    )
    return last_wins(rows, ["type", "name"], ["id"], "_order")


def enrich_tree(tree: DataFrame, lookup: DataFrame, entry_id: str | None = None) -> DataFrame:
    """Set ``id`` of each element from ``lookup`` (unique on type and name).

    Elements without an entry in the lookup keep the id they have, or get a NULL id. List
    order and length, the difference between NULL and empty lists, and all other columns
    are kept. Elements are looked up one by one and regrouped by ``entry_id``; what is
    regrouped is what the entry held before. An ``entry_id`` that occurs twice fails the
    query, as its entries could not be told apart. Without an ``entry_id`` column the entries are numbered and written once,
    so that the number cannot change when a lost task runs again. The lookup is written
    too: as a stored table its size is known before the join (broadcast or not), and a
    join of two plain shuffles can be split where one name holds very many elements.
    """
    lookup = materialise(lookup, "lookup")
    key = entry_id or "_entry"
    if entry_id is None:
        tree = materialise(tree.withColumn(key, F.monotonically_increasing_id()), "tree")

    def placed(group: str) -> Column:
        items = F.transform(
            F.col(group),
            lambda x, i: F.struct(
                F.lit(group).alias("group"), i.alias("pos"), x.alias("item")
            ),
        )
        return F.coalesce(items, F.array())

    missing = [F.col(g).isNull().alias(f"_no_{g}") for g in GROUPS]
    others = [c for c in tree.columns if c not in (key, *GROUPS)]
    kept = F.struct(*others, F.lit(None).cast("string").alias("_none")).alias("_kept")
    elements = tree.select(
        key,
        kept,
        *missing,
        F.posexplode_outer(F.concat(*[placed(g) for g in GROUPS])).alias("_nth", "e"),
    ).select(key, "_kept", "_nth", *[f"_no_{g}" for g in GROUPS], "e.*")
    has_id = "id" in tree.select(F.explode(GROUPS[0]).alias("x")).select("x.*").columns
    own = F.col("item.id").cast("string") if has_id else F.lit(None).cast("string")
    found = elements.join(
        lookup.select(
            F.col("type").alias("_type"), F.col("name").alias("_name"), F.col("id").alias("_id")
        ),
        (F.col("item.type") == F.col("_type")) & (F.col("item.name") == F.col("_name")),
        "left",
    ).withColumn("item", F.when(F.col("item").isNotNull(), F.col("item").withField("id", F.coalesce("_id", own))))

    def regroup(group: str) -> Column:
        mine = F.when(F.col("group") == group, F.struct("pos", "item"))
        items = F.transform(F.sort_array(F.collect_list(mine)), lambda x: x["item"])
        return F.when(~F.max(f"_no_{group}"), items).alias(group)

    # Each entry has one first element, or one row without any.
    entries = F.count_if(F.coalesce(F.col("_nth"), F.lit(0)) == 0).alias("_entries")
    grouped = found.groupBy(key).agg(
        F.any_value("_kept").alias("_kept"), entries, *[regroup(g) for g in GROUPS]
    )
    stop = F.raise_error(F.concat(F.lit("repeated entry id: "), F.col(key).cast("string")))
    return grouped.filter(
        F.when(F.col("_entries") == 1, F.lit(True)).otherwise(stop.cast("boolean"))
    ).select(
        *([key] if entry_id else []),
        *GROUPS,
        *[F.col("_kept").getField(c).alias(c) for c in others],
    )
