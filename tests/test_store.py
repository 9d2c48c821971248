"""The bucketed store: what a write touches, what a failed one leaves, what a plan shuffles."""

import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.sources import store as module
from kinweave.sources.store import KeyedStore
from kinweave.sources.tables import DuplicateKeyError

SCHEMA = T.StructType().add("id", "long").add("name", "string").add("note", "string")


@pytest.fixture
def store(spark, tmp_path):
    out = KeyedStore(spark, str(tmp_path / "store"))
    out.declare("Person", SCHEMA, "id", buckets=8)
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return {r.id: (r.name, r.note) for r in df.collect()}


def test_loads_and_merges_equal_a_dict(spark, store):
    rng, want = random.Random(1), {}
    for step in range(12):
        ids = rng.sample(range(60), rng.randrange(1, 15))
        if step % 3 == 0:
            ids = [i for i in ids if i not in want]
            store.load("Person", frame(spark, [(i, f"n{i}", f"s{step}") for i in ids]))
            want |= {i: (f"n{i}", f"s{step}") for i in ids}
        else:
            batch = [(i, f"x{step}-{v}", v) for i in ids for v in range(rng.randrange(1, 4))]
            df = spark.createDataFrame(batch + [(None, "no", 9)], "id long, name string, v int")
            small = rng.choice([0, 1000])
            store.merge("Person", df, ["name"], "v", small_batch=small)
            for i, name, _ in batch:
                want[i] = (name, want.get(i, (None, None))[1])
        assert rows_of(store.table("Person")) == want
        assert store.table("Person").count() == len(want)


def test_only_touched_buckets_are_written(spark, store):
    store.load("Person", frame(spark, [(i, "a", "b") for i in range(200)]))
    before = store.files("Person")
    one = frame(spark, [(7, "new", None)])
    touched = store._touched("Person", one)
    assert len(touched) == 1
    store.merge("Person", one, ["name"])
    after = store.files("Person")
    assert {b for b in after if after[b] != before[b]} == set(touched)
    assert rows_of(store.table("Person"))[7] == ("new", "b")
    assert rows_of(store.table("Person", version=1))[7] == ("a", "b")
    store.load("Person", frame(spark, [(1000, "x", None)]))
    third = store.files("Person")
    assert all(set(after[b]) <= set(third[b]) for b in after)  # a load rewrites nothing


def test_parts_of_a_bucket_are_put_together(spark, store, monkeypatch):
    monkeypatch.setattr(module, "MOST_PARTS", 2)
    for n in range(5):
        store.load("Person", frame(spark, [(n * 10 + i, "a", None) for i in range(10)]))
    assert store.table("Person").count() == 50
    assert all(len(parts) <= 3 for parts in store.manifest("Person").values())


def test_refused_loads_change_nothing(spark, store):
    store.load("Person", frame(spark, [(1, "a", "b"), (2, "c", None)]))
    for rows in ([(3, "x", "y"), (3, "z", "y")], [(9, "x", "y"), (2, "x", "y")], [(None, "x", "y")]):
        for small in (0, 1000):
            with pytest.raises(DuplicateKeyError):
                store.load("Person", frame(spark, rows), small_batch=small)
    assert rows_of(store.table("Person")) == {1: ("a", "b"), 2: ("c", None)}
    assert len(store._versions("Person")) == 1


def test_failed_write_leaves_the_old_version(spark, store, monkeypatch):
    store.load("Person", frame(spark, [(i, "a", "b") for i in range(20)]))
    want = rows_of(store.table("Person"))

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(KeyedStore, "_commit", broken)  # after the data is written
        with pytest.raises(OSError):
            store.merge("Person", frame(spark, [(1, "x", "y"), (99, "z", "y")]), ["name", "note"])
    again = KeyedStore(spark, store.root)
    again.declare("Person", SCHEMA, "id", buckets=8)
    assert rows_of(again.table("Person")) == want
    again.merge("Person", frame(spark, [(1, "x", "y")]), ["name"])
    assert rows_of(again.table("Person")) == {**want, 1: ("x", "b")}


def test_stored_side_is_not_shuffled(spark, store):
    store.load("Person", frame(spark, [(i, "a", "b") for i in range(50)]))
    spec, stored = store.tables["Person"], store.table("Person")
    batch = frame(spark, [(3, "x", None)])
    for df in store.plan_merge(spec, stored, batch, ["name"], True):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan
        assert not re.search(r"(?<!Broadcast)Exchange|Sort\b|SortMergeJoin", plan)


def test_keys_of_two_columns_and_empty_tables(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "edges"))
    schema = T.StructType().add("src", "string").add("dst", "string").add("w", "double")
    store.declare("KNOWS", schema, ["src", "dst"], buckets=4)
    assert store.table("KNOWS").count() == 0
    empty = spark.createDataFrame([], schema)
    assert store.merge("KNOWS", empty, ["w"]).count() == 0
    assert store.load("KNOWS", empty).count() == 0
    rows = spark.createDataFrame([("a", "b", 1.0), ("a", "c", 2.0), ("a", "b", 3.0), ("a", None, 1.0)], schema)
    store.merge("KNOWS", rows, ["w"])
    store.merge("KNOWS", rows.filter("dst = 'c'").withColumn("w", F.lit(9)), ["w"])
    assert sorted(map(tuple, store.table("KNOWS").collect())) == [("a", "b", 3.0), ("a", "c", 9.0)]
    with pytest.raises(ValueError):
        store.declare("X", schema, "none")
