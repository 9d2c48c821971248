"""Session settings and the one place that writes intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def recommended_conf() -> dict[str, str]:
    """Settings the operators are planned for.

    Joins against key-unique tables leave skew to adaptive execution: it splits
    an oversized probe partition from measured map output, at no extra pass.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.filterPushdown": "true",
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder, from ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own: on a cluster a
    machine-local path would be lost with its executor.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="kinweave-")
    return _LOCAL_DIRS[app]


def shared_path(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared folder, for a table that is about to be written."""
    return f"{shared_dir(spark)}/kinweave/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage and fixes values that must not change when a lost task is
    recomputed (positions, answers of an external model).
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    # Once the table is written nothing reads the shuffles it came from: free their disk.
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
