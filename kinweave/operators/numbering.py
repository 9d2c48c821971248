"""Dense numbering of rows in a total order, without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from kinweave.session import materialise

# Layout of monotonically_increasing_id: partition in the upper bits, row in the lower 33.
ROW_BITS = 33


def partition_offsets(counts: DataFrame) -> DataFrame:
    """From (part, n): (part, offset), the number of rows in earlier partitions.

    Reads one row per partition of a finished table, so its size is the partition
    count and not the data.
    """
    total, rows = 0, []
    for part, n in sorted(counts.collect()):
        rows.append((part, total))
        total += n
    return counts.sparkSession.createDataFrame(rows, "part long, offset long")


def assign_index(df: DataFrame, order_cols: list[str], index_col: str = "index") -> DataFrame:
    """Add a 1-based index in the order of ``order_cols`` (NULLs first).

    ``order_cols`` should identify a row, so that the numbers do not depend on the
    partitioning. One range shuffle and a local sort; the sorted rows are written
    once, because both the offsets and the result must see the same partitions.
    """
    placed = materialise(
        df.orderBy(*order_cols).withColumn("_place", F.monotonically_increasing_id()), "index"
    )
    part = F.shiftright("_place", ROW_BITS)
    offsets = partition_offsets(
        placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    )
    row = F.col("_place") - F.shiftleft(part, ROW_BITS)
    return (
        placed.withColumn("part", part)
        .join(F.broadcast(offsets), "part")  # one row per partition
        .withColumn(index_col, F.col("offset") + row + 1)
        .drop("part", "offset", "_place")
    )


def assign_ids(
    df: DataFrame, order_cols: list[str], prefix: str, id_col: str = "id"
) -> DataFrame:
    """Add ids ``<prefix>1``, ``<prefix>2``, ... in the order of ``order_cols``."""
    numbered = assign_index(df, order_cols, "_index")
    return numbered.withColumn(
        id_col, F.concat(F.lit(prefix), F.col("_index").cast("string"))
    ).drop("_index")


def slice_rows(
    df: DataFrame, order_cols: list[str], start: int = 0, end: int | None = None
) -> DataFrame:
    """Rows ``[start, end)`` of the ordered input (NULLs first); no end means all the rest.

    The two bounds are found first: the order columns alone are dealt into ranges, whose sizes
    tell the ranges that hold the bounds, and one sorted range gives a bound's values. Only rows
    between them are then read whole, numbered and sorted. Rows equal in all order columns are
    told apart by a hash of all their columns.
    """
    if start < 0 or (end is not None and (end < 0 or end <= start)):
        raise ValueError("need end > start and both non-negative")
    if start == 0 and end is None:
        return df.orderBy(*order_cols)
    names = [f"_k{i}" for i in range(len(order_cols))]
    keys = df.select(*[F.col(c).alias(n) for c, n in zip(order_cols, names)])
    ranges = materialise(
        keys.repartitionByRange(*names).withColumn("_range", F.spark_partition_id()), "slice-keys"
    )
    sizes = sorted(ranges.groupBy("_range").count().collect())
    # The first row of the slice, and the last one if there is an end before the last row.
    low = _row_at(ranges, sizes, names, start)
    if low is None:
        return df.limit(0)
    high = _row_at(ranges, sizes, names, end - 1) if end is not None else None
    # NULLs are compared as the smallest values inside a struct, as the sort has them.
    whole = F.struct(*[F.col(c).alias(n) for c, n in zip(order_cols, names)])

    def bound(row: Row) -> Column:
        kinds = [keys.schema[n].dataType for n in names]
        return F.struct(*[F.lit(row[n]).cast(k).alias(n) for n, k in zip(names, kinds)])

    inside = whole >= bound(low)
    if high is not None:
        inside = inside & (whole <= bound(high))
    # Places before the first row that equals the lower bound.
    of_keys = F.struct(*names)
    before = ranges.filter(of_keys < bound(low)).count()
    tie = F.xxhash64(*df.columns)
    numbered = assign_index(
        df.filter(inside).withColumn("_tie", tie), [*order_cols, "_tie"], "_index"
    )
    place = F.col("_index") + before
    kept = numbered.filter(place > start)
    if end is not None:
        kept = kept.filter(place <= end)
    return kept.orderBy("_index").drop("_index", "_tie")


def _row_at(ranges: DataFrame, sizes: list, names: list[str], at: int) -> Row | None:
    """The key at a place of the order, None beyond the last."""
    for part, n in sizes:
        if at < n:
            nth = F.row_number().over(Window.orderBy(*names))
            rows = ranges.filter(F.col("_range") == part).withColumn("_nth", nth)
            return rows.filter(F.col("_nth") == at + 1).first()
        at -= n
    return None
