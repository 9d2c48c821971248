"""The log of answers: calls counted over a killed and repeated run."""

import pytest
from pyspark.sql import functions as F

from kinweave.operators.answers import answered
from kinweave.operators.embed import embed, hashed_ngrams
from kinweave.operators.resolve import judge_by_function

CANDIDATES = "array<struct<id long, fullName string>>"


def questions(spark, n):
    rows = [(i % (n // 2), f"name {i % (n // 2)}", [(i % 3, "x"), (7, None)] if i % 5 else None) for i in range(n)]
    return spark.createDataFrame(rows, f"id int, name string, candidates {CANDIDATES}")


def test_a_killed_run_asks_only_what_it_had_not_written(spark, tmp_path):
    calls, failing = spark.sparkContext.accumulator(0), spark.sparkContext.broadcast([30])
    log = str(tmp_path / "log")

    def judge(sample, listed):
        if failing.value[0] and int(sample["name"].split()[1]) == failing.value[0]:
            raise OSError("killed")
        calls.add(1)
        return (listed[0]["id"] if listed else None), "high"

    df = questions(spark, 80)
    different = df.select("name", F.to_json(F.struct("candidates"))).distinct().count()
    with pytest.raises(Exception, match="killed"):
        judge_by_function(df, judge, sample=["name"], log=log, log_rows=10).count()
    written = spark.read.parquet(log).count()
    assert 0 < written < different
    calls = spark.sparkContext.accumulator(0)
    failing = spark.sparkContext.broadcast([None])
    done = judge_by_function(df, judge, sample=["name"], log=log, log_rows=10).collect()
    assert calls.value == different - written
    assert len(done) == 80
    assert all(r.answer == (r.candidates[0].id if r.candidates else None) for r in done)
    calls = spark.sparkContext.accumulator(0)
    again = judge_by_function(df.repartition(7), judge, sample=["name"], log=log).collect()
    assert calls.value == 0 and sorted(again) == sorted(done)
    more = questions(spark, 80).withColumn("name", F.concat("name", F.lit("0")))
    judge_by_function(df.unionByName(more.limit(3)), judge, sample=["name"], log=log).count()
    assert 0 < calls.value <= 3


def test_vectors_are_kept_over_runs(spark, tmp_path):
    calls, log = spark.sparkContext.accumulator(0), str(tmp_path / "vectors")

    def model(texts):
        calls.add(len(texts))
        return hashed_ngrams(texts)

    df = spark.createDataFrame([(i, f"text {i % 9}" if i else None) for i in range(30)], "id int, t string")
    first = embed(df, "t", model, log=log).orderBy("id").collect()
    assert calls.value == 9
    assert embed(df, "t", model, log=log).orderBy("id").collect() == first
    assert calls.value == 9
    embed(df.withColumn("t", F.concat("t", F.lit("!"))).limit(4), "t", model, log=log).count()
    assert 9 < calls.value <= 13
    plain = embed(df, "t").orderBy("id").collect()
    assert [r.vector for r in plain] == [r.vector for r in first]


def test_no_questions(spark, tmp_path):
    empty = spark.createDataFrame([], "_digest string, text string")
    found = answered(empty, lambda df: df.withColumn("answer", F.lit(1)), str(tmp_path / "none"))
    assert found.count() == 0
