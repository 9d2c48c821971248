"""Preparation of the two vector tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.functions.columns import make_key
from kinweave.operators.keys import keep_one
from kinweave.schemas import KEYED_REFERENCE

# Fixed value: category text in the key of a person without a prize.
NO_CATEGORY = "no prize"


def keyed_source(df: DataFrame) -> DataFrame:
    """Source rows under the shorter key ``name category``, one row per key.

    Vectors were made from the longer key with the year; the row of the smallest year
    (then of all other columns) stays.
    """
    key = make_key(F.lower("name"), F.coalesce(F.lower("category"), F.lit(NO_CATEGORY)))
    rest = sorted(c for c in df.columns if c not in ("pk", "year", "vector"))
    return keep_one(df.withColumn("pk", key), ["pk"], ["year", *rest])


def keyed_reference(df: DataFrame) -> DataFrame:
    """Reference rows, one per key, with the columns of the reference table only."""
    columns = [c for c in KEYED_REFERENCE.fieldNames() if c in df.columns]
    order = [c for c in columns if c not in ("pk", "vector")]
    return keep_one(df, ["pk"], order).select(*columns)
