"""Reading and writing nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_records(
    spark: SparkSession, path: str, schema: StructType, layout: str = "lines"
) -> DataFrame:
    """Read nested records with an explicit schema.

    ``lines`` (one JSON object per line) and ``parquet`` split over tasks; ``array``
    reads files that are one JSON array each, one task per file.
    """
    reader = spark.read.schema(schema)
    if layout == "parquet":
        return reader.parquet(path)
    if layout == "lines":
        return reader.option("mode", "FAILFAST").json(path)
    if layout == "array":
        return reader.option("mode", "FAILFAST").option("multiLine", True).json(path)
    raise ValueError(f"unknown layout {layout!r}")


def assemble_pages(
    spark: SparkSession, path: str, page_schema: StructType, list_field: str, layout: str = "lines"
) -> DataFrame:
    """All records of a folder of result pages, each page holding a list of them."""
    pages = read_records(spark, path, page_schema, layout)
    return pages.select(F.explode(list_field).alias("_record")).select("_record.*")


def write_records(
    df: DataFrame, path: str, layout: str = "lines", compression: str | None = None
) -> None:
    """Replace the target with ``df``; NULL fields are written, not left out.

    ``compression`` is a codec of the layout's writer. Lines packed by ``gzip`` are read back
    by one task a file, so they suit tables that are written in many parts.
    """
    writer = df.write.mode("overwrite")
    if compression is not None:
        writer = writer.option("compression", compression)
    if layout == "parquet":
        writer.parquet(path)
    elif layout == "lines":
        writer.option("ignoreNullFields", "false").json(path)
    else:
        raise ValueError(f"unknown layout {layout!r}")
