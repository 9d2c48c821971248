"""Reshaping operators on small nested inputs."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from kinweave import schemas
from kinweave.operators import numbering, reshape
from kinweave.operators.keys import keep_one, last_wins
from kinweave.operators.keyed import keyed_source
from kinweave.sources.records import assemble_pages, read_records, write_records


def laureate(name, category, year):
    return {"name": name, "type": "laureate", "category": category, "year": year}


def scholar(name):
    return {"name": name, "type": "scholar"}


TREE = [
    {"children": [laureate("George Smith", "Physics", 2009)], "parents": [scholar("Andrew Lawson")]},
    {"children": [laureate("John Bardeen", "Physics", 1956)], "parents": [scholar("Eugene Wigner")]},
    {"children": [laureate("John Bardeen", "Physics", 1972)], "parents": []},
    {"children": [laureate("Marie Curie", "Physics", 1903), scholar("A")], "parents": [scholar("B"), scholar("C")]},
    {"children": [laureate("Marie Curie", "Chemistry", 1911)]},
]


def nested(spark, rows, schema):
    return spark.createDataFrame([json.dumps(r) for r in rows], "string").select(
        F.from_json("value", schema).alias("r")
    ).select("r.*")


@pytest.fixture(scope="module")
def tree(spark):
    return nested(spark, TREE, schemas.TREE)


def test_stack_keeps_one_all_null_row_and_sorts(tree):
    rows = reshape.stack_entities(tree).collect()
    names = [r.name for r in rows]
    assert names == sorted(names, key=lambda n: (n is not None, n or ""))
    assert names.count(None) == 1
    assert len(rows) == 5 + 5 + 1  # five laureate rows, five scholars, the empty one


def test_laureate_keys(tree):
    got = {r.pk for r in reshape.laureate_keys(tree).collect()}
    assert "john bardeen physics 1956" in got and "john bardeen physics 1972" in got
    assert len(got) == 5


def test_keyed_source_drops_the_year(tree):
    got = {(r.pk, r.year) for r in keyed_source(reshape.laureate_keys(tree)).collect()}
    assert ("john bardeen physics", 1956) in got
    assert ("marie curie chemistry", 1911) in got and ("marie curie physics", 1903) in got
    assert len(got) == 4


def test_entity_ids(tree):
    got = {r.name: r.id for r in reshape.entity_ids(tree).collect()}
    assert got == {"A": "s1", "Andrew Lawson": "s2", "B": "s3", "C": "s4", "Eugene Wigner": "s5"}


def test_mentor_pairs_product_and_fan_out(spark):
    def ent(name, kind, id_, year=None):
        return {"name": name, "type": kind, "id": id_, "category": None, "year": year}

    rows = [
        {"children": [ent("X", "laureate", "l1", 1), ent("Y", "laureate", "l2")],
         "parents": [ent("P", "scholar", "s1"), ent("Q", "scholar", "s2")]},
        {"children": [ent("X", "laureate", "l1", 2)], "parents": [ent("P", "scholar", "s1")]},
        {"children": [ent("Z", "laureate", None)], "parents": []},
    ]
    df = nested(spark, rows, schemas.TREE_WITH_IDS)
    plain = reshape.mentor_pairs(df)
    # X stands for two entities: each of its rows doubles.
    got = sorted(
        ((r.parent_name, r.child_name, r.parent_id, r.child_id) for r in plain.collect()), key=str
    )
    assert got.count(("P", "X", "s1", "l1")) == 4
    assert got.count(("Q", "X", "s2", "l1")) == 2
    assert got.count(("P", "Y", "s1", "l2")) == 1
    assert (None, "Z", None, None) in got
    weighted = {tuple(r)[:4]: r.n_rows for r in reshape.mentor_pairs(df, weighted=True).collect()}
    assert weighted == {k: got.count(k) for k in set(got)}


RAW = [
    {"id": "1", "knownName": {"en": "N"}, "fullName": {"en": "Full N"}, "gender": "male",
     "birth": {"date": "1898-00-00", "place": {"city": {"en": "Murray Hill, NJ"}, "countryNow": {"en": "USA"}}},
     "nobelPrizes": [
         {"awardYear": "1954", "category": {"en": "Chemistry"}, "portion": "1", "dateAwarded": "1954-11-03",
          "affiliations": [{"name": {"en": "Inst"}, "nameNow": {"en": "Inst"}, "cityNow": {"en": "P, CA"},
                            "countryNow": {"en": "USA"}, "continent": {"en": "North America"}}]},
         {"awardYear": "1962", "category": {"en": "Peace"}, "portion": "1"}]},
    {"id": "2", "fullName": {"en": "Pax"}, "gender": "female", "nobelPrizes": [
        {"awardYear": "1905", "category": {"en": "Peace"}}]},
    {"id": "3", "fullName": {"en": "Two"}, "gender": "male", "nobelPrizes": [
        {"awardYear": "1956", "category": {"en": "Physics"}}, {"awardYear": "1972", "category": {"en": None}}]},
    {"id": "4", "fullName": {"en": "None"}, "gender": "male", "nobelPrizes": []},
]


def test_reshape_raw_modes(spark):
    raw = nested(spark, RAW, schemas.RAW_RECORD)
    per_prize = reshape.reshape_raw(raw).orderBy("id").collect()
    # Once per qualifying prize (a NULL category qualifies), each time with all prizes.
    assert [(r.id, len(r.prizes)) for r in per_prize] == [("1", 2), ("3", 2), ("3", 2)]
    exists = reshape.reshape_raw(raw, mode="exists").orderBy("id").collect()
    assert [r.id for r in exists] == ["1", "3"]
    first = exists[0]
    assert first.birthPlaceCity == "Murray Hill, NJ" and first.birthPlaceCountry is None
    assert first.givenName is None and first.deathDate is None
    assert [p.category for p in first.prizes] == ["Chemistry", "Peace"]
    assert first.prizes[0].affiliations[0].cityNow == "P, CA"
    assert first.prizes[1].affiliations == []
    assert reshape.reshape_raw(raw).schema.simpleString() == schemas.REFERENCE.simpleString()


def test_frames_of_reference_records(spark):
    ref = reshape.reshape_raw(nested(spark, RAW[:1], schemas.RAW_RECORD))
    ref = ref.withColumn("knownName", F.coalesce("knownName", "fullName"))
    person = reshape.persons_frame(ref).first()
    assert (person.id, person.birthPlaceCity, person.birthPlaceState) == ("l1", "Murray Hill", "NJ")
    assert person.birthDate == datetime.date(1898, 1, 1)
    prizes = sorted(r.prize_id for r in reshape.prizes_frame(ref).collect())
    assert prizes == ["1954_chemistry", "1962_peace"]
    aff = reshape.affiliations_frame(ref).collect()
    assert [tuple(r) for r in aff] == [("l1", "Inst", "P", "CA", "USA", "North America")]


def test_missing_required_field_fails_or_is_reported(spark):
    ref = reshape.reshape_raw(nested(spark, RAW[2:3], schemas.RAW_RECORD), mode="exists")
    with pytest.raises(Exception, match="missing knownName"):
        reshape.persons_frame(ref).collect()
    assert reshape.persons_frame(ref, on_error="quarantine").count() == 0
    assert [r.errors for r in reshape.rejected_persons(ref).collect()] == [["missing knownName"]]


def test_prizes_frame_keeps_records_without_prizes(spark):
    ref = nested(spark, [{"id": "9", "prizes": []}], schemas.REFERENCE)
    row = reshape.prizes_frame(ref).first()
    assert row.laureate_id == "l9" and row.prize_id is None
    assert reshape.affiliations_frame(ref).count() == 0


def test_json_round_trip_keeps_nulls(spark, tmp_path, tree):
    path = str(tmp_path / "tree")
    write_records(tree, path)
    text = "".join(r.value for r in spark.read.text(path).collect())
    assert '"category":null' in text
    back = read_records(spark, path, schemas.TREE)
    assert back.exceptAll(tree).count() == 0 and tree.exceptAll(back).count() == 0
    write_records(tree.limit(1), path)  # replaces the target
    assert read_records(spark, path, schemas.TREE).count() == 1


def test_array_file_and_pages(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(TREE))
    assert read_records(spark, str(tmp_path / "a.json"), schemas.TREE, "array").count() == len(TREE)
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "1.json").write_text(json.dumps({"laureates": RAW[:3]}))
    (pages / "2.json").write_text(json.dumps({"laureates": RAW[3:]}))
    got = assemble_pages(spark, str(pages), schemas.RAW_PAGE, "laureates")
    assert sorted(r.id for r in got.collect()) == ["1", "2", "3", "4"]


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_index_does_not_depend_on_partitioning(spark, parts):
    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("v")).repartition(parts)
    got = numbering.assign_index(df, ["v"], "n").collect()
    assert {(r.v, r.n) for r in got} == {(i, i + 1) for i in range(500)}


def test_index_of_nothing(spark):
    assert numbering.assign_index(spark.range(0), ["id"]).count() == 0


def test_slice(spark):
    df = spark.range(50).repartition(5)
    assert [r.id for r in numbering.slice_rows(df, ["id"], 10, 15).collect()] == list(range(10, 15))
    assert [r.id for r in numbering.slice_rows(df, ["id"], 47).collect()] == [47, 48, 49]
    assert numbering.slice_rows(df, ["id"]).count() == 50
    for start, end in ((5, 5), (-1, 3), (3, 1)):
        with pytest.raises(ValueError):
            numbering.slice_rows(df, ["id"], start, end)


@pytest.mark.parametrize("start, end", [(0, 7), (3, 40), (25, 26), (38, 80), (59, None), (60, 70), (0, 60)])
def test_slice_of_ties_and_nulls(spark, start, end):
    rows = [(i % 7 or None, "x" if i % 3 else None, [float(i)] * 3) for i in range(60)]
    df = spark.createDataFrame(rows, "a int, b string, v array<double>").repartition(4)
    got = numbering.slice_rows(df, ["a", "b"], start, end)
    order = sorted(((a is not None, a or 0), (b is not None, b or "")) for a, b, _ in rows)
    want = order[start:end]
    assert [((r.a is not None, r.a or 0), (r.b is not None, r.b or "")) for r in got.collect()] == want
    assert got.columns == df.columns
    assert len({r.v[0] for r in got.collect()}) == len(want)
    parts = [r.v[0] for r in numbering.slice_rows(df.repartition(9), ["a", "b"], start, end).collect()]
    assert sorted(parts) == sorted(r.v[0] for r in got.collect())


def test_slices_part_the_input(spark):
    rows = [(i // 10, [float(i)]) for i in range(50)]
    df = spark.createDataFrame(rows, "a int, v array<double>")
    seen = [r.v[0] for at in range(0, 50, 7) for r in numbering.slice_rows(df, ["a"], at, at + 7).collect()]
    assert sorted(seen) == [float(i) for i in range(50)]


def test_slice_shuffles_the_order_columns_alone(spark, monkeypatch):
    written = []
    keep = numbering.materialise
    monkeypatch.setattr(numbering, "materialise", lambda df, name: written.append((name, df)) or keep(df, name))
    df = spark.range(1000).select("id", F.array(F.col("id").cast("double")).alias("v"))
    assert numbering.slice_rows(df, ["id"], 10, 15).count() == 5
    (_, keys), (_, rows) = written
    assert keys.columns == ["_k0", "_range"]
    assert rows.count() == 5  # of the whole rows, only those of the slice are numbered


def test_last_wins_keeps_nulls_of_the_winner(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", None, 2), ("b", "y", 1)], "k string, v string, o int")
    assert {(r.k, r.v) for r in last_wins(df, ["k"], ["v"], "o").collect()} == {("a", None), ("b", "y")}
    assert keep_one(df, ["k"], ["o"]).count() == 2
