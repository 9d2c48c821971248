"""Documents, their copies and their anchors: what both repeat searches do before they differ."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from kinweave.session import materialise

# A row is known by its id and a hash of its text; rows equal in both are one document.
KEY = ["_id", "_h"]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_h"), F.col(text_col).alias("_text")
    )


def join_key(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    right = b.withColumnsRenamed({"_id": "_id2", "_h": "_h2"})
    on = F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_h") == F.col("_h2"))
    return a.join(right, on, how).drop("_id2", "_h2")


def described(
    rows: DataFrame, work: Callable[[bytes], tuple[int, str, np.ndarray, np.ndarray]], name: str
) -> DataFrame:
    """One row per document: key, ``_n``, ``_sha`` of all of it, anchor codes and places.

    ``work`` gives the four from a text's bytes. Written once, as later steps start from it.
    """
    schema = T.StructType(
        [
            rows.schema["_id"],
            T.StructField("_h", T.LongType()),
            T.StructField("_n", T.LongType()),
            T.StructField("_sha", T.StringType()),
            T.StructField("_codes", T.ArrayType(T.LongType())),
            T.StructField("_places", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [work(t.as_py() or b"") for t in batch.column(2).cast(pa.binary())]
            sizes, shas, codes, places = zip(*found) if found else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(shas, pa.string()),
                    lists([c.view(np.int64) for c in codes]),
                    lists(places),
                ],
                names=schema.names,
            )

    return materialise(rows.mapInArrow(run, schema), name)


def lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate([*parts, np.zeros(0, dtype=np.int64)]).astype(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def repeated(entries: DataFrame, key: list[str]) -> DataFrame:
    """The entries whose key occurs more than once.

    Counts are combined before they are shuffled, and stored before the join: that makes it a
    join of two plain shuffles, in which adaptive execution can split a common key.
    """
    often = entries.groupBy(*key).agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1")
    return entries.join(materialise(often.drop("_times"), "repeated"), key)


def one_per_key(df: DataFrame) -> DataFrame:
    """The rows without those that repeat a key; they hold the same in all other columns."""
    repeats = df.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1")
    return df if repeats.isEmpty() else df.dropDuplicates(KEY)


def copies(facts: DataFrame) -> DataFrame:
    """Per ``_sha``: the first key that has it (``_id``, ``_h``) and the number of keys."""
    order = F.struct(F.col("_id").isNull().alias("_null"), "_id", "_h")
    return (
        facts.groupBy("_sha")
        .agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_keys"))
        .select("_sha", "_first._id", "_first._h", "_keys")
    )


def candidates(rows: DataFrame, facts: DataFrame, firsts: DataFrame, name: str) -> DataFrame:
    """Key, text and ``_at`` of documents with anchors that occur more than once.

    Of texts that are equal as a whole only the first of ``firsts`` stands for all.
    """
    anchor = facts.select(*KEY, F.explode(F.arrays_zip("_codes", "_places")).alias("_a")).select(
        *KEY, F.col("_a._codes").alias("_code"), F.col("_a._places").alias("_place")
    )
    met = repeated(anchor, ["_code"]).groupBy(*KEY).agg(F.collect_list("_place").alias("_at"))
    chosen = join_key(met, firsts.select(*KEY))
    return materialise(join_key(rows, chosen), name)


def mapped(df: DataFrame, work: Callable, columns: list[str], schema: str) -> DataFrame:
    """``work(text, *values)`` for each row gives rows; returns them after the row's key.

    ``columns`` are the values; ``work`` yields one array or list for each field of ``schema``,
    all of one length.
    """
    spark = df.sparkSession
    fields = spark.createDataFrame([], schema).schema
    out = T.StructType([df.schema["_id"], T.StructField("_h", T.LongType()), *fields])
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, parts = [], [[] for _ in kinds]
            texts = batch.column(2).cast(pa.binary())
            values = [batch.column(3 + i) for i in range(len(columns))]
            for row in range(batch.num_rows):
                found = work(
                    texts[row].as_py() or b"",
                    *(np.array(v[row].values, dtype=np.int64) for v in values),
                )
                owner.append(np.full(len(found[0]), row))
                for part, column in zip(parts, found):
                    part.append(column if isinstance(column, pa.Array) else pa.array(column))
            if not batch.num_rows:
                continue
            take = pa.array(np.concatenate(owner))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(take),
                    batch.column(1).take(take),
                    *(
                        pa.concat_arrays([a.cast(kind) for a in part])
                        for part, kind in zip(parts, kinds)
                    ),
                ],
                names=out.names,
            )

    return df.select(*KEY, "_text", *columns).mapInArrow(run, out)
