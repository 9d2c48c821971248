"""Exact deduplication: local, salted and global combining on the full content."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.llm.words import SPACES
from kinweave.session import materialise

SALTS = 16
LONG_MAX = "9223372036854775807"
# Place value of the length in a rank; ids need the 65 bits below.
LENGTH_PLACE = str(1 << 65)
DEC = "decimal(38,0)"


def squeezed(text: Column) -> Column:
    """The text without white space; NULL counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def _rank(text: Column, doc_id: Column) -> Column:
    """Greatest for the longest text, then the smallest id; a NULL id comes last.

    A decimal and not a struct, as Spark combines decimals in its hash aggregate.
    """
    place = F.lit(LONG_MAX).cast(DEC) - doc_id.cast(DEC) + F.lit(1).cast(DEC)
    length = F.coalesce(F.length(text), F.lit(0)).cast(DEC)
    return (
        length * F.lit(LENGTH_PLACE).cast(DEC) + F.coalesce(place, F.lit(0).cast(DEC))
    ).cast(DEC)


def _id_of(rank: Column) -> Column:
    place = rank % F.lit(LENGTH_PLACE).cast(DEC)
    doc_id = F.lit(LONG_MAX).cast(DEC) - (place - F.lit(1).cast(DEC))
    return F.when(place > 0, doc_id.cast("long"))


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def _contents(rows: DataFrame, salts: int) -> DataFrame:
    """One row per distinct content: its best rank and its number of rows.

    Copies meet first within their task (the map side of the aggregate), then within a
    salted share of their digest, then once per content. The content itself is part of
    every key, so no stage takes a digest for the content.
    """
    salted = rows.groupBy("_digest", "_salt", "_content").agg(
        F.max("_rank").alias("_rank"), F.count(F.lit(1)).alias("_n")
    )
    return (
        salted.repartition("_digest")
        .groupBy("_digest", "_content")
        .agg(F.max("_rank").alias("_best"), F.sum("_n").alias("_size"))
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """Add ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` to every row.

    Texts are equal if nothing but white space tells them apart. Of equal texts the one
    with most code points stays, then the smallest id; NULL ids come last. NULL and empty
    texts are equal. Rows that repeat the id and the length of the row that stays are that
    same document and all say ``kept``; ``drop_exact`` leaves one of them. Columns of these
    four names in the input are replaced; an empty input gives no rows.

    The texts are shuffled for the groups only. A row finds its group by digest where all
    texts of the digest were seen to be one content; where they were not, by the content.
    """
    content = squeezed(F.col(text_col))
    out = ["keep_id", "group_size", "kept", "text_sha256"]
    docs = docs.drop(*out)
    # The input's columns travel in one, so that none can be taken for a column made here.
    ranked = docs.select(
        F.struct(*docs.columns).alias("_doc"),
        _rank(F.col(text_col), F.col(id_col)).alias("_rank"),
        digest(content).alias("_digest"),
        sha256(content).alias("_sha"),
    )
    rows = docs.select(
        digest(content).alias("_digest"),
        F.pmod(F.xxhash64(id_col), F.lit(salts)).alias("_salt"),
        content.alias("_content"),
        _rank(F.col(text_col), F.col(id_col)).alias("_rank"),
    )
    per_digest = materialise(
        _contents(rows, salts)
        .groupBy("_digest")
        .agg(
            F.count(F.lit(1)).alias("_contents"),
            F.max("_best").alias("_best"),
            F.sum("_size").alias("_size"),
        ),
        "exact",
    )
    single = per_digest.filter("_contents = 1").drop("_contents")
    found = ranked.join(single, "_digest")
    shared = per_digest.filter("_contents > 1").select("_digest")
    if not shared.isEmpty():
        of_digest = rows.join(shared, "_digest", "left_semi")
        told_apart = _contents(of_digest, salts)
        found = found.unionByName(
            ranked.withColumn("_content", squeezed(F.col("_doc").getField(text_col)))
            .join(told_apart, ["_digest", "_content"])
            .drop("_content")
        )
    return found.select(
        *(F.col("_doc").getField(name).alias(name) for name in docs.columns),
        _id_of(F.col("_best")).alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_rank") == F.col("_best")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, one for each group of equal texts, with the input's columns."""
    whole = docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.struct(*docs.columns).alias("_row")
    )
    kept = exact_groups(whole, "_id", "_text").filter("kept")
    return kept.groupBy("text_sha256").agg(F.first("_row").alias("_row")).select("_row.*")
