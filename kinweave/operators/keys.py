"""Operators that keep or count one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, key: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in ``order``.

    The rank limit is applied before the shuffle too, so at most one row per key
    and task is moved, however many rows a key has.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def last_wins(df: DataFrame, key: list[str], values: list[str], order: Column | str) -> DataFrame:
    """For each key the values of its greatest row in ``order``.

    The values travel in a struct, so a NULL in the winning row stays NULL; so does the
    order, as a row with a NULL order comes before all others and is not left out. The
    aggregate is combined map-side.
    """
    if not values:
        return df.select(*key).distinct()
    best = F.max_by(F.struct(*values), F.struct(order))
    return df.groupBy(*key).agg(best.alias("_best")).select(*key, "_best.*")


def top_k_per_group(
    df: DataFrame, group: list[str], order: list[Column | str], k: int, rank_col: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each group in ``order`` with their rank."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def key_collisions(df: DataFrame, key: list[str], value: str) -> DataFrame:
    """Keys that stand for more than one value (homonyms lost by a last-wins lookup)."""
    return (
        df.groupBy(*key)
        .agg(F.count_distinct(value).alias("n_values"))
        .filter("n_values > 1")
    )
