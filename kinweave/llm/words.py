"""What the operators share: words, row identity, running totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The white space that parts words, as a character class and as characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"

# Rows of a running total that one task sums.
TOTAL_BLOCK = 4096


def word_count(text: Column) -> Column:
    """Number of words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_total(df: DataFrame, index: str, value: str, total: str) -> DataFrame:
    """Add the sum of ``value`` over the rows before each, in the order of a dense ``index``.

    Blocks of rows are summed in parallel; only one row per 4,096 meets in one task.
    """
    block = F.floor(F.col(index) / TOTAL_BLOCK).cast("long")
    inner = Window.partitionBy("_block").orderBy(index)
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        df.groupBy(block.alias("_block"))
        .agg(F.sum(value).alias("_sum"))
        .withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .drop("_sum")
    )
    return (
        df.withColumn("_block", block)
        .withColumn("_upto", F.sum(value).over(inner) - F.col(value))
        .join(blocks, "_block")
        .withColumn(total, F.col("_base") + F.col("_upto"))
        .drop("_block", "_base", "_upto")
    )
