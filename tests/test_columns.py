"""Column functions against hand-written expectations."""

import datetime

import pytest
from pyspark.sql import functions as F

from kinweave.functions import columns as C
from kinweave.functions.checks import validate, vector_ok


def apply(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_key_is_null_if_any_part_is_null(spark):
    df = spark.createDataFrame([("John Bardeen", "Physics", 1956), ("X", None, 1)], "a string, b string, c int")
    got = df.select(C.make_key(F.lower("a"), F.lower("b"), F.col("c")).alias("k")).collect()
    assert [r.k for r in got] == ["john bardeen physics 1956", None]


def test_replace_first_only(spark):
    assert apply(spark, ["a-a", "b", None, "a"], lambda c: C.replace_first(c, "a", "x$1")) == [
        "x$1-a", "b", None, "x$1",
    ]


def test_short_category(spark):
    got = apply(spark, ["Physiology or Medicine", "Economic Sciences", "Physics", None], C.short_category)
    assert got == ["medicine", "economics", "physics", None]


def test_canonicalise(spark):
    got = apply(spark, ["Economic Sciences", "Other", None], lambda c: C.canonicalise(c, C.CATEGORY_NAMES))
    assert got == ["Economics", "Other", None]


def test_null_safe_exclusion_keeps_null(spark):
    got = apply(spark, ["Peace", "Physics", None], lambda c: C.none_of(c, ["Peace", "Literature"]))
    assert got == [False, True, True]


def test_strict_casts_raise(spark):
    assert apply(spark, ["2009"], C.strict_long) == [2009]
    assert apply(spark, ["2009-10-06"], C.strict_date) == [datetime.date(2009, 10, 6)]
    with pytest.raises(Exception):
        apply(spark, ["20x9"], C.strict_long)
    with pytest.raises(Exception):
        apply(spark, ["2009-13-06"], C.strict_date)


def test_repair_date(spark):
    day = datetime.date
    got = apply(
        spark,
        ["1898-00-00", "1898-07-00", "2009-1-5", "1930-05-10", "garbage", "", None, "09-01-05", "2021-02-30"],
        C.repair_date,
    )
    assert got == [
        day(1898, 1, 1), day(1898, 7, 1), day(2009, 1, 5), day(1930, 5, 10), None, None, None, None, None,
    ]


def test_prefix_id(spark):
    assert apply(spark, ["840", "l840", None], lambda c: C.prefix_id(c, "l")) == ["l840", "l840", None]


CITIES = ["Murray Hill, NJ", "A, B, C", "Paris", "", None]


def test_person_city(spark):
    assert apply(spark, CITIES, C.person_city) == ["Murray Hill", "A, B, C", "Paris", "", None]
    assert apply(spark, CITIES, lambda c: C.person_state(c, F.lit("was"))) == ["NJ", "was", "was", "was", "was"]


def test_affiliation_city(spark):
    assert apply(spark, CITIES, C.affiliation_city) == ["Murray Hill", "A", "Paris", "", None]
    got = apply(spark, CITIES, lambda c: C.affiliation_state(c, F.lit("was")))
    assert got == ["NJ", None, None, "was", "was"]


def test_kind_from_id(spark):
    assert apply(spark, ["l1", "s1", "x", None], C.kind_from_id) == ["laureate", "scholar", None, None]


def test_similarity_and_contains(spark):
    assert apply(spark, [0.25], C.similarity, "double") == [0.75]
    assert apply(spark, ["john bardeen", "marie curie", "bohr"], lambda c: C.contains_any(c, "bardeen", "curie")) == [
        True, True, False,
    ]


def test_validate(spark):
    df = spark.createDataFrame([("1", "high"), (None, "low"), ("2", "maybe")], "id string, c string")
    split = validate(df, ["id"], {"c": ["high", "low"]}, on_error="quarantine")
    assert [r.id for r in split.valid.collect()] == ["1"]
    assert sorted(r.errors[0] for r in split.rejected.collect()) == ["bad c", "missing id"]
    with pytest.raises(Exception, match="invalid record"):
        validate(df, ["id"]).valid.count()
    assert validate(df.filter("id = '1'"), ["id"]).valid.count() == 1


def test_vector_ok(spark):
    got = apply(
        spark,
        [[1.0, 2.0], [1.0], [1.0, None], None, [float("nan"), 1.0]],
        lambda c: vector_ok(c, 2),
        "array<double>",
    )
    assert got == [True, False, False, False, False]
