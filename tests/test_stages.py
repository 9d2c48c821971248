"""All stages on a small hand-made network, from raw pages to the graph."""

import json

import pytest
from pyspark.sql import functions as F

from kinweave import schemas
from kinweave.operators.embed import hashed_ngrams
from kinweave.operators.paths import incoming_counts, lookup
from kinweave.operators.resolve import (
    candidates,
    edit_similarity,
    judge_by_function,
    judge_by_score,
    name_score,
    resolve,
    token_overlap,
)
from kinweave.plans import stages
from kinweave.sources.records import read_records
from kinweave.sources.tables import GraphFolder
from tests.test_reshape import laureate, nested, scholar


def en(value):
    return {"en": value}


def person(id_, name, prizes, birth="1900-01-01", city="Paris", country="France", gender="male"):
    return {
        "id": id_, "knownName": en(name), "fullName": en(name), "gender": gender,
        "birth": {"date": birth, "place": {"city": en(city), "countryNow": en(country)}},
        "nobelPrizes": prizes,
    }


def prize(year, category, *affiliations):
    return {
        "awardYear": year, "category": en(category), "portion": "1", "dateAwarded": f"{year}-10-10",
        "motivation": en("m"), "prizeAmount": 1, "prizeAmountAdjusted": 2,
        "affiliations": [
            {"name": en(n), "nameNow": en(n), "cityNow": en(c), "countryNow": en(k), "continent": en(w)}
            for n, c, k, w in affiliations
        ],
    }


LABS = ("Bell Laboratories", "Murray Hill, NJ", "USA", "North America")
PEOPLE = [
    person("840", "George E. Smith", [prize("2009", "Physics", LABS)], "1930-05-10", "White Plains, NY", "USA"),
    person("66", "John Bardeen", [prize("1956", "Physics"), prize("1972", "Physics")], "1908-05-23", "Madison, WI", "USA"),
    person("6", "Marie Curie", [prize("1903", "Physics"), prize("1911", "Chemistry",
           ("Sorbonne", "Paris", "France", "Europe"))], "1867-11-07", "Warsaw", "Poland", "female"),
    person("21", "Niels Bohr", [prize("1922", "Physics", ("Copenhagen University", "Copenhagen", "Denmark", "Europe"))],
           "1885-00-00", "Copenhagen", "Denmark"),
    person("102", "Aage N. Bohr", [prize("1975", "Physics")], "1922-06-00", "Copenhagen", "Denmark"),
    person("217", "Linus Pauling", [prize("1954", "Chemistry", ("Caltech", "Pasadena, CA, X", "Utopia", "North America")),
           prize("1962", "Peace")], "", "Portland, OR", "USA"),
    person("500", "Peace Only", [prize("1950", "Peace")]),
]
TREE = [
    {"children": [laureate("George Smith", "Physics", 2009)], "parents": [scholar("Andrew Lawson")]},
    {"children": [laureate("John Bardeen", "Physics", 1956)], "parents": [scholar("Eugene Wigner"), scholar("John Bardeen")]},
    {"children": [laureate("John Bardeen", "Physics", 1972)], "parents": [scholar("Eugene Wigner")]},
    {"children": [laureate("Marie Curie", "Physics", 1903)], "parents": []},
    {"children": [laureate("Marie Curie", "Chemistry", 1911)]},
    {"children": [laureate("Niels Bohr", "Physics", 1922)],
     "parents": [scholar("J. J. Thomson"), scholar("E. Rutherford"), scholar("C. Christiansen")]},
    {"children": [laureate("Aage Bohr", "Physics", 1975)], "parents": [laureate("Niels Bohr", "Physics", 1922)]},
    {"children": [laureate("Linus Pauling", "Chemistry", 1954)], "parents": [scholar("R. Dickinson")]},
]


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """Every stage once, in order."""
    root = tmp_path_factory.mktemp("world")
    pages = root / "pages"
    pages.mkdir()
    for i in range(0, len(PEOPLE), 3):
        (pages / f"{i}.json").write_text(json.dumps({"laureates": PEOPLE[i : i + 3]}))
    stages.raw_stage(spark, str(pages), str(root / "reference"))
    ref = read_records(spark, str(root / "reference"), schemas.REFERENCE)
    tree = nested(spark, TREE, schemas.TREE)
    vectors = GraphFolder(spark, str(root / "vectors"))
    stages.vector_stage(vectors, tree, ref)
    resolved = stages.resolution_stage(vectors)
    mapping = resolved.matched.select("source", "matched_record", "confidence")
    enriched = stages.merge_stage(tree, mapping)
    graph, counts = stages.graph_stage(GraphFolder(spark, str(root / "graph")), enriched.tree, ref)
    return {"ref": ref, "vectors": vectors, "resolved": resolved, "enriched": enriched, "graph": graph, "counts": counts}


def test_reference_repeats_records_per_prize(world):
    ids = sorted(r.id for r in world["ref"].select("id").collect())
    assert ids == sorted(["840", "66", "66", "6", "6", "21", "102", "217"])


def test_repeat_winners_in_the_reference_table(world):
    rows = lookup(
        world["vectors"].table("Reference"), "pk", ["bardeen", "curie"],
        ["fullName", "category", "awardYear"], ["fullName", "category", "awardYear"],
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("John Bardeen", "Physics", "1956"), ("John Bardeen", "Physics", "1972"),
        ("Marie Curie", "Chemistry", "1911"), ("Marie Curie", "Physics", "1903"),
    ]


def test_similar_edges(world):
    edges = world["vectors"].table("SIMILAR_TO").collect()
    sources = world["vectors"].table("Scholar").count()
    assert len(edges) == 3 * sources
    best = {}
    for e in edges:
        best[e.src] = max(best.get(e.src, (-1, "")), (e.similarity_score, e.dst))
    assert best["george smith physics"][1] == "george e. smith physics 2009"


def test_every_source_is_resolved(world):
    got = {r.source.name: r.matched_record.id for r in world["resolved"].matched.collect()}
    assert got == {"George Smith": 840, "John Bardeen": 66, "Marie Curie": 6, "Niels Bohr": 21,
                   "Aage Bohr": 102, "Linus Pauling": 217}
    assert world["resolved"].rejected.count() == 0


def test_ids_by_kind(world):
    ids = {}
    for row in world["enriched"].tree.collect():
        for e in (row.children or []) + (row.parents or []):
            ids.setdefault((e.type, e.name), set()).add(e.id)
    assert ids["laureate", "John Bardeen"] == {"l66"}
    assert len(ids["scholar", "John Bardeen"]) == 1 and next(iter(ids["scholar", "John Bardeen"]))[0] == "s"


def test_mentor_counts(world):
    counts = incoming_counts(world["graph"], "MENTORED", "fullName", ["Bohr"], "n").collect()
    assert {tuple(r) for r in counts} == {("Niels Bohr", 3), ("Aage N. Bohr", 1)}
    rows, distinct = world["counts"]["mentored"].first()
    assert rows > distinct  # Bardeen stands for two entities, which repeats his rows


def test_graph_tables(world):
    nodes, edges = world["graph"].nodes, world["graph"].edges
    cities = {r.name: r.state for r in nodes["City"].collect()}
    assert cities["Murray Hill"] == "NJ" and cities["Pasadena"] is None and cities["Madison"] == "WI"
    countries = {r.name for r in nodes["Country"].collect()}
    assert "Utopia" not in countries and "USA" in countries  # only birth countries are nodes
    assert {(r.src, r.dst) for r in edges["IS_COUNTRY_IN"].collect()} == {("USA", "North America"), ("Denmark", "Europe")}
    assert edges["DIED_IN"].count() == 0
    people = {r.id: r for r in nodes["Scholar"].collect()}
    assert str(people["l21"].birthDate) == "1885-01-01" and people["l217"].birthDate is None
    assert people["l66"].scholar_type == "laureate"
    assert {r.id for r in nodes["Prize"].collect()} >= {"1956_physics", "1972_physics", "1962_peace"}
    assert edges["WON"].filter("src = 'l66'").count() == 2
    for name, (src, dst) in world["graph"].ends.items():
        for column, label in (("src", src), ("dst", dst)):
            key = world["graph"].keys[label]
            ends = edges[name].select(F.col(column).alias("k"))
            assert ends.join(nodes[label], F.col("k") == F.col(key), "left_anti").count() == 0


def test_outside_judge_and_rejected_answers(world):
    def judge(sample, listed):
        if sample["name"] == "Niels Bohr":
            return -5, "high"  # not a candidate
        if sample["name"] == "Aage Bohr":
            return listed[0]["id"], "perhaps"  # no known label
        return min(c["id"] for c in listed), "high"

    done = stages.resolution_stage(world["vectors"], judge=judge, concurrency=3)
    reasons = {r.source.name: r.reason for r in done.rejected.collect()}
    assert reasons == {"Niels Bohr": "answer is not a candidate", "Aage Bohr": "unknown confidence"}
    assert done.matched.count() + done.rejected.count() == world["vectors"].table("Scholar").count()


def test_slice_and_approximate_search(world):
    some = stages.resolution_stage(world["vectors"], start=1, end=3)
    assert some.matched.count() == 2
    near = stages.resolution_stage(world["vectors"], approximate=True)
    assert {r.source.name: r.matched_record.id for r in near.matched.collect()}["Niels Bohr"] == 21


def test_resolution_searches_and_builds_nothing_again(world, monkeypatch):
    def forbidden(*_, **__):
        raise AssertionError("searched again")

    stages.stored_index(world["vectors"])  # stored by now
    monkeypatch.setattr(stages, "topk_similarity", forbidden)
    monkeypatch.setattr(stages, "build_vector_index", forbidden)
    monkeypatch.setattr(stages, "slice_rows", forbidden)
    for approximate in (False, True):
        done = stages.resolution_stage(world["vectors"], approximate=approximate)
        assert done.matched.count() == world["resolved"].matched.count()


def test_the_last_record_in_order_wins(spark, world, tmp_path):
    def record(name, place, portion):
        return (
            "7", name, name, "male", "1900-01-01", f"Paris, {place}" if place else "Paris", None,
            [{"awardYear": "1950", "category": "Physics", "portion": portion, "motivation": name}],
        )

    schema = (
        "id string, knownName string, fullName string, gender string, birthDate string, "
        "birthPlaceCity string, deathDate string, prizes array<struct<awardYear string, category string, "
        "portion string, dateAwarded string, motivation string, prizeAmount long, prizeAmountAdjusted long, "
        "affiliations array<struct<name string, nameNow string, city string, country string, cityNow string, "
        "countryNow string, continent string>>>>"
    )
    rows = [record("A", "Z", "1/3"), record("Z", "A", "1/2"), record("M", None, "1/4")]
    tree = world["enriched"].tree
    for order in ([2, 1, 0], [0, 2, 1], [0, 1, 2]):
        ref = spark.createDataFrame(rows, schema).withColumn("position", F.lit(0))
        place = F.element_at(F.create_map(*[F.lit(x) for n, k in zip("AZM", order) for x in (n, k)]), F.col("fullName"))
        folder = GraphFolder(spark, str(tmp_path / "".join(map(str, order))))
        graph, _ = stages.graph_stage(folder, tree, ref.withColumn("position", place), "position")
        last = "AZM"[order.index(2)]
        person = graph.nodes["Scholar"].filter("id = 'l7'").first()
        assert (person.name, person.fullName) == (last, last)
        assert graph.nodes["Prize"].first().motivation == last
        assert graph.edges["WON"].first().portion == {"A": "1/3", "Z": "1/2", "M": "1/4"}[last]
        assert graph.nodes["City"].first().state == {"A": "Z", "Z": "A", "M": None}[last]


def test_default_score(spark):
    df = spark.createDataFrame(
        [("Niels Bohr", "Physics", [(1, "Niels Bohr", "Niels Henrik Bohr", "Physics"), (2, "A. Bohr", "Aage Bohr", None)])],
        "name string, category string, candidates array<struct<id long, knownName string, fullName string, category string>>",
    )
    judged = judge_by_score(df, lambda c: name_score(F.col("name"), F.col("category"), c)).first()
    assert (judged.answer, judged.confidence, judged.score) == (1, "high", 1.0)
    pair = df.select(edit_similarity(F.lit("ab"), F.lit("abcd")), token_overlap(F.lit("a b"), F.lit("b c"))).first()
    assert tuple(pair) == (0.5, pytest.approx(1 / 3))


def test_no_candidates_is_rejected(spark):
    df = spark.createDataFrame([("X", None)], "name string, candidates array<struct<id long, fullName string>>")
    judged = judge_by_score(df, lambda c: edit_similarity(F.col("name"), c["fullName"]))
    done = resolve(judged, source=["name"])
    assert done.matched.count() == 0 and done.rejected.count() == 1
    asked = judge_by_function(df, lambda s, c: (None, "low"), sample=["name"])
    assert resolve(asked, source=["name"]).rejected.count() == 1


def test_candidates_list_a_person_once(spark):
    near = spark.createDataFrame([("s", "a", 0.9, 1), ("s", "b", 0.8, 2), ("s", "c", 0.7, 3)],
                                 "source_id string, target_id string, score double, rank int")
    targets = spark.createDataFrame([("a", 7, "x"), ("b", 8, "y"), ("c", 7, "z")], "pk string, id long, t string")
    kept = candidates(near, targets, "pk", ["id", "t"], seed=None).first().candidates
    assert [(c.id, c.t) for c in kept] == [(7, "x"), (8, "y")]
    for seed in (0, 1):
        mixed = candidates(near, targets, "pk", ["id", "t"], seed=seed).first().candidates
        assert {c.id for c in mixed} == {7, 8}
        assert mixed == candidates(near.repartition(3), targets, "pk", ["id", "t"], seed=seed).first().candidates


def test_copies_of_a_record_take_little_disk(spark, tmp_path):
    """A record is written once for each prize with all prizes in it: the square of their number."""
    prizes = [
        {"awardYear": str(1800 + i), "category": {"en": "Physics"}, "motivation": {"en": f"work {i * 7919}"}}
        for i in range(60)
    ]
    (tmp_path / "pages.json").write_text(json.dumps({"laureates": [{"id": "1", "nobelPrizes": prizes}]}))
    stages.raw_stage(spark, str(tmp_path / "pages.json"), str(tmp_path / "reference"))
    ref = read_records(spark, str(tmp_path / "reference"), schemas.REFERENCE)
    assert [len(r.prizes) for r in ref.collect()] == [60] * 60
    stored = sum(p.stat().st_size for p in (tmp_path / "reference").glob("part-*"))
    assert stored < 3 * len(json.dumps(prizes))


def test_only_rows_that_stay_are_embedded(spark, tmp_path):
    """The vector of a kept source row is that of its own longer key, made once."""
    texts = spark.sparkContext.accumulator(0)

    def embedder(some):
        texts.add(len(some))
        return hashed_ngrams(some)

    tree = nested(spark, [
        {"children": [laureate("Marie Curie", "Physics", year)], "parents": []} for year in (1911, 1903, 1920)
    ], schemas.TREE)
    prizes = [{"awardYear": "1903", "category": "Physics"}]
    people = [{"id": i, "fullName": "Marie Curie", "prizes": prizes} for i in ("6", "7")]
    ref = nested(spark, people, schemas.REFERENCE)
    folder = GraphFolder(spark, str(tmp_path / "vectors"))
    stages.vector_stage(folder, tree, ref, embedder)
    kept = folder.table("Scholar").collect()
    assert [(r.pk, r.year) for r in kept] == [("marie curie physics", "1903")]
    want = hashed_ngrams(["marie curie physics 1903"])[0].astype("float32").tolist()
    assert kept[0].vector == want
    assert [(r.pk, r.id) for r in folder.table("Reference").collect()] == [("marie curie physics 1903", "6")]
    assert texts.value == 2
