"""A stored log of what outside models answered, so that no question is asked twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kinweave.session import materialise

# Questions that one write of the log answers: what a killed run may have to ask again.
CHUNK_ROWS = 100_000
DIGEST = "_digest"


def read_log(questions: DataFrame, path: str, schema: StructType) -> DataFrame:
    """The answers of a log, one per digest; none if it was never written."""
    spark = questions.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).dropDuplicates([DIGEST])


def answered(
    questions: DataFrame,
    ask: Callable[[DataFrame], DataFrame],
    path: str,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The answer to every question, from the log where it has one.

    ``questions`` has a ``_digest`` that is unique and stands for all a question depends on;
    ``ask`` turns some of them into ``_digest`` and answers, looking at each once. Only
    questions whose digest is not in the log are asked, in chunks of about ``chunk_rows`` by
    the digest, and each chunk is appended to the log before the next one begins. A run that
    is killed asks again what its last chunk had not written; one that finds all answers asks
    nothing. One writer at a time is assumed; an answer written twice counts once.
    """
    schema = ask(questions.limit(0)).schema
    known = read_log(questions, path, schema)
    todo = materialise(questions.join(known.select(DIGEST), DIGEST, "left_anti"), "questions")
    chunks = -(-todo.count() // chunk_rows)
    part = F.pmod(F.xxhash64(DIGEST), F.lit(max(1, chunks)))
    for chunk in range(chunks):
        ask(todo.filter(part == chunk)).write.mode("append").parquet(path)
    return read_log(questions, path, schema)
