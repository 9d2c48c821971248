"""Choosing one candidate per source row."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Any, NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.operators.answers import CHUNK_ROWS, DIGEST, answered
from kinweave.session import materialise

# Confidence labels of a mapping record.
CONFIDENCE = ["high", "low"]

Judge = Callable[[dict[str, Any], list[dict[str, Any]]], tuple[Any, str]]


class Resolved(NamedTuple):
    matched: DataFrame
    rejected: DataFrame


def candidates(
    neighbours: DataFrame,
    targets: DataFrame,
    target_id: str,
    record: list[str],
    *,
    record_id: str = "id",
    seed: int | None = 0,
) -> DataFrame:
    """(source_id, candidates): the neighbours of each source row as records.

    A person found through several target rows is listed once, at the best rank. With a
    seed the list is put in an order that says nothing about the rank; ``None`` keeps
    the rank order. A list has at most as many entries as there are ranks.
    """
    payload = targets.select(F.col(target_id).alias("target_id"), F.struct(*record).alias("_record"))
    listed = (
        neighbours.select("source_id", "target_id", "rank", "score")
        .join(payload, "target_id")
        .groupBy("source_id")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "score", "_record"))).alias("_all"))
    )
    distinct = F.filter(
        "_all",
        lambda x, i: ~F.exists(
            F.slice("_all", F.lit(1), i),
            lambda y: y["_record"][record_id] == x["_record"][record_id],
        ),
    )
    listed = listed.select("source_id", distinct.alias("_all"))
    if seed is not None:
        listed = listed.withColumn("_all", shuffled(F.col("_all"), record_id, seed))
    return listed.select(
        "source_id",
        F.transform(
            "_all", lambda x: F.struct(*[x["_record"][c].alias(c) for c in record])
        ).alias("candidates"),
    )


def shuffled(items: Column, record_id: str, seed: int) -> Column:
    """The list in the order of a hash of id and seed: random looking, but repeatable."""
    keyed = F.transform(
        items,
        lambda x: F.struct(
            F.md5(
                F.concat(x["_record"][record_id].cast("string"), F.lit(f":{seed}")).cast("binary")
            ).alias("at"),
            x.alias("item"),
        ),
    )
    return F.transform(F.sort_array(keyed), lambda x: x["item"])


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - Levenshtein distance / longer length."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longest)


def token_overlap(a: Column, b: Column) -> Column:
    """Shared share of the blank-separated words."""
    left, right = F.split(a, " "), F.split(b, " ")
    return F.size(F.array_intersect(left, right)) / F.size(F.array_union(left, right))


def name_score(
    name: Column,
    category: Column | None,
    candidate: Column,
    weights: tuple[float, float, float] = (0.6, 0.2, 0.2),
) -> Column:
    """Default judge's score: edit similarity and word overlap of the better of the two
    candidate names, and equality of the category."""
    source = F.lower(name)
    names = [F.lower(candidate["knownName"]), F.lower(candidate["fullName"])]
    edit = F.greatest(*[F.coalesce(edit_similarity(source, n), F.lit(0.0)) for n in names])
    words = F.greatest(*[F.coalesce(token_overlap(source, n), F.lit(0.0)) for n in names])
    same = F.lit(0.0)
    if category is not None:
        same = F.coalesce(
            (F.lower(category) == F.lower(candidate["category"])).cast("double"), F.lit(0.0)
        )
    return weights[0] * edit + weights[1] * words + weights[2] * same


def judge_by_score(
    df: DataFrame,
    score: Callable[[Column], Column],
    *,
    record_id: str = "id",
    threshold: float = 0.6,
    margin: float = 0.05,
    digits: int = 6,
) -> DataFrame:
    """Add ``answer`` and ``confidence`` from a score per candidate.

    The best score wins, then the smaller id. ``high`` needs a score of at least
    ``threshold`` and a lead of at least ``margin`` over the next candidate.
    """
    ranked = F.sort_array(
        F.transform(
            "candidates",
            lambda c: F.struct(
                (-F.round(score(c), digits)).alias("cost"), c[record_id].alias("id")
            ),
        )
    )
    best, next_best = F.get("_ranked", F.lit(0)), F.get("_ranked", F.lit(1))
    top = -best["cost"]
    lead = F.round(top - F.coalesce(-next_best["cost"], F.lit(0.0)), digits)
    return (
        df.withColumn("_ranked", ranked)
        .withColumn("answer", best["id"])
        .withColumn("score", top)
        .withColumn(
            "confidence",
            F.when(
                best.isNotNull(),
                F.when((top >= threshold) & (lead >= margin), "high").otherwise("low"),
            ),
        )
        .drop("_ranked")
    )


def judge_by_function(
    df: DataFrame,
    judge: Judge,
    *,
    sample: list[str],
    answer_type: str = "long",
    partitions: int | None = None,
    concurrency: int = 1,
    log: str | None = None,
    log_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add ``answer`` and ``confidence`` from an outside judge, asked once per row.

    Rows are judged in parallel over partitions, and up to ``concurrency`` at a time
    within one. The answers are written before anything reads them. With a ``log``, a folder
    that stays, equal samples with equal candidates are one question, which is asked only if
    the log does not have it; see :func:`kinweave.operators.answers.answered`.
    """
    if log is not None:
        question = F.to_json(F.struct(*sample, "candidates"), {"ignoreNullFields": "false"})
        rows = materialise(df.withColumn(DIGEST, F.sha2(question, 256)), "judged-rows")
        # Lists have a few entries, so a question is a small row.
        asked = rows.select(DIGEST, *sample, "candidates").dropDuplicates([DIGEST])

        def ask(some: DataFrame) -> DataFrame:
            found = _ask(some, judge, sample, answer_type, partitions, concurrency)
            return found.select(DIGEST, "answer", "confidence")

        answers = answered(asked, ask, log, log_rows)
        return rows.join(answers, DIGEST, "left").drop(DIGEST)
    return materialise(_ask(df, judge, sample, answer_type, partitions, concurrency), "answers")


def _ask(
    df: DataFrame,
    judge: Judge,
    sample: list[str],
    answer_type: str,
    partitions: int | None,
    concurrency: int,
) -> DataFrame:
    if partitions:
        df = df.repartition(partitions)
    fields = [f for f in df.schema.fields]
    schema = T.StructType(
        fields
        + [
            T.StructField("answer", T._parse_datatype_string(answer_type)),
            T.StructField("confidence", T.StringType()),
        ]
    )

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(max_workers=concurrency) as pool:
            for batch in batches:
                samples = batch[sample].to_dict("records")
                lists = [list(c) if c is not None else [] for c in batch["candidates"]]
                answers = list(pool.map(judge, samples, lists))
                yield batch.assign(
                    answer=[a[0] for a in answers], confidence=[a[1] for a in answers]
                )

    return df.mapInPandas(ask, schema)


def resolve(
    judged: DataFrame, *, source: list[str], record_id: str = "id", keep: list[str] | None = None
) -> Resolved:
    """Mapping records from judged rows.

    ``matched`` has ``source``, ``matched_record`` and ``confidence``; a row whose answer
    is not among its candidates, or whose confidence is no known label, is in
    ``rejected`` with a reason. Together they hold every input row once.
    """
    keep = keep or []
    hit = F.get(F.filter("candidates", lambda c: c[record_id] == F.col("answer")), F.lit(0))
    rows = judged.select(
        *keep,
        F.struct(*source).alias("source"),
        hit.alias("matched_record"),
        "confidence",
        "answer",
    )
    known = F.coalesce(F.col("confidence").isin(CONFIDENCE), F.lit(False))
    good = F.col("matched_record").isNotNull() & known
    reason = F.when(F.col("matched_record").isNull(), "answer is not a candidate").otherwise(
        "unknown confidence"
    )
    return Resolved(
        rows.filter(good).drop("answer"),
        rows.filter(~good).withColumn("reason", reason).drop("matched_record"),
    )
