"""Every operator on small inputs: plain versions, nulls, empties, ties, repeats, odd columns."""

import random

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from kinweave.llm import (
    exact,
    language,
    mixture,
    packing,
    passages,
    quality,
    simhash,
    strings,
    topk,
    urls,
)
from kinweave.llm.components import components
from kinweave.llm.queries import QUERIES, SQL
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
# Columns named like those that the operators make or use inside.
ODD = "kept string, score string, _row string, _size string, _doc string, _id string, rank string"
SCHEMA = f"doc_id long, text string, lang string, source string, {ODD}"
ODD_VALUES = tuple("odd" for _ in ODD.split(","))


def text_of(rng, n):
    return " ".join(rng.choice("ab cd ef gh ij kl mn op qr st uv wx".split()) for _ in range(n))


def make_rows():
    rng = random.Random(1)
    base = text_of(rng, 90)
    rows = [
        (1, base, "en", "a"),
        (2, base.replace(" ", "\n"), "en", "a"),
        (3, base + " tail", "en", None),
        (4, "Head " + base, None, "b"),
        (5, text_of(rng, 40) + " " + base[:150], "en", "b"),
        (6, "", "en", "a"),
        (7, None, "en", "c"),
        (8, " \t\n", "en", "c"),
        (9, "one", "en", "b"),
        (10, "be " * 60, "en", "a"),
        (None, "no id " + text_of(rng, 30), "en", "a"),
        (12, "ÀÉ straße 日本 " * 8, "de", "b"),
        (13, "w%d " * 20 % tuple(range(20)) * 3, "de", "b"),
        (14, text_of(rng, 20_000), "de", "z"),
        (15, base, "en", "a"),
    ]
    return rows


ROWS = make_rows()
PAIRS = [(r[0], r[1]) for r in ROWS]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame([(*r, *ODD_VALUES) for r in ROWS], SCHEMA)
    return frame.repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def twice(spark):
    """Rows that repeat as a whole, also without an id."""
    rows = [(1, "same text here", "en", "a")] * 3 + [(None, "other", "en", None)] * 2
    return spark.createDataFrame([(*r, *ODD_VALUES) for r in rows], SCHEMA)


def tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(SQL[name])
    assert [c[0] for c in result.description] == df.columns
    assert tuples(df) == sorted(result.fetchall(), key=repr)


@pytest.mark.parametrize(
    "name, plain", [("op4_", brute.near), ("op8_", brute.passages), ("op10_", brute.strings)]
)
def test_queries_against_plain_versions(spark, name, plain):
    query = next(q for key, q in QUERIES.items() if key.startswith(name))
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    assert tuples(query(spark, SF_DIR)) == sorted(plain([tuple(r) for r in table.collect()]), key=repr)


def test_learned_queries_on_held_out_rows(spark):
    sf_dir = SF_DIR.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = QUERIES["op7_language_id"](spark, sf_dir).filter("held_out").join(docs, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in found) > 0.97 * len(found) > 300
    found = QUERIES["op1_quality_classifier"](spark, sf_dir).filter("held_out")
    found = found.join(labels, "doc_id").collect()
    assert sum(r.quality == r.predicted for r in found) > 0.9 * len(found) > 80
    clean = [r for r in found if r.quality == 1]
    assert sum(r.predicted for r in clean) > 0.95 * len(clean)


# Exact dedup.


def test_exact_groups(docs):
    found = exact.exact_groups(docs)
    rows = {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in found.collect()}
    assert rows == {d: (k, n, s) for d, k, n, s in brute.exact(PAIRS)}
    assert {r.doc_id for r in found.filter("kept").collect()} == {k for _, k, _, _ in brute.exact(PAIRS)}
    assert found.schema["score"].dataType.simpleString() == "string"


def test_exact_tells_texts_of_one_digest_apart(docs):
    weak = exact.exact_groups(docs, digest=lambda c: F.substring(F.sha2(c, 256), 1, 1))
    assert tuples(weak) == tuples(exact.exact_groups(docs))


def test_exact_repeats_and_empty(twice, empty):
    found = exact.exact_groups(twice).collect()
    assert [r.kept for r in found] == [True] * 5
    assert sorted((r.doc_id, r.group_size) for r in found if r.doc_id) == [(1, 3)] * 3
    assert exact.drop_exact(twice).count() == 2
    assert exact.drop_exact(twice).columns == twice.columns
    assert exact.exact_groups(empty).count() == 0 == exact.drop_exact(empty).count()


# Near dedup.


@pytest.mark.parametrize("long_list", [1, 2048])
def test_near_groups(docs, long_list):
    assert tuples(simhash.near_groups(docs, long_list=long_list)) == sorted(brute.near(PAIRS), key=repr)


def test_near_repeats_and_empty(docs, twice, empty):
    assert simhash.drop_near(empty).count() == 0 == simhash.near_groups(empty).count()
    assert sorted(r.doc_id or 0 for r in simhash.drop_near(twice).collect()) == [0, 0, 1]
    kept = {r.doc_id for r in simhash.drop_near(docs).collect()}
    groups = {c for d, _, c in brute.near(PAIRS) if d is not None}
    assert kept - {None} == groups


def test_near_keeps_repeated_ids_of_other_components(spark):
    rng = random.Random(8)
    one, two, three = (text_of(rng, 60) for _ in range(3))
    rows = [(1, one), (1, two), (2, two), (3, one), (1, one), (2, three), (4, three), (2, one), (5, None), (5, "x")]
    frame = spark.createDataFrame([(i, t, "odd") for i, t in rows], "doc_id long, text string, _fp string")
    kept = sorted(((r.doc_id, r.text or "") for r in simhash.drop_near(frame.repartition(3)).collect()))
    assert kept == sorted([(1, one), (1, two), (2, three), (5, ""), (5, "x")])


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    links += [(100, 100 + i) for i in range(1, 30)] + [(200 + i, 201 + i) for i in range(25)]
    parent = {x: x for pair in links for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert all(found.get(x, x) == root(x) for x in parent)


# Repeated passages and strings.


@pytest.mark.parametrize("work, plain", [(passages.remove_passages, brute.passages), (strings.remove_strings, brute.strings)])
def test_repeats(docs, empty, twice, work, plain):
    assert tuples(work(docs)) == sorted(plain(PAIRS), key=repr)
    assert work(empty).count() == 0
    # Rows equal in id and text are one document and take nothing from each other.
    assert [r.n_removed for r in work(twice).collect()] == [0] * 5


def test_strings_of_common_keys_are_counted_alike(docs):
    assert tuples(strings.remove_strings(docs, key_bytes=250)) == sorted(brute.strings(PAIRS), key=repr)


# Packing.


def test_packing(docs, twice, empty):
    for frame in (docs, twice):
        rows = packing.pack_documents(frame, TOKENIZER, capacity=512).collect()
        bins = {}
        for r in rows:
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for parts in bins.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 512
        total = sum(r.length for r in rows)
        assert len(bins) == -(-total // 512)
        assert all(r.length == 512 for r in rows if (r.doc_id, r.piece + 1) in {(x.doc_id, x.piece) for x in rows})
    assert packing.pack_documents(empty, TOKENIZER).count() == 0
    short = {r.doc_id: r.length for r in packing.pack_documents(docs, TOKENIZER).collect() if r.doc_id in (6, 7, 8)}
    assert short == {6: 1, 7: 1, 8: 1}


# Mixing.


def test_mix(docs, twice, empty):
    mix = mixture.mix_sources(docs, block_words=8)
    rows = mixture.taken_words(mix).collect()
    sizes = {r[0]: len(brute.words(r[1])) for r in ROWS}
    assert {r.doc_id: r["size"] for r in rows} == sizes
    assert all(r.taken <= 3 * r["size"] for r in rows)
    total = sum(sizes.values())
    assert sum({r.source_size: r.target for r in rows}.values()) == pytest.approx(total)
    source = {r[0]: r[3] for r in ROWS}
    for name in {r[3] for r in ROWS}:
        own = [r for r in rows if source[r.doc_id] == name]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 16
        assert own[0].target <= 3 * own[0].source_size
    again = mixture.taken_words(mixture.mix_sources(docs.repartition(5), block_words=8))
    assert tuples(again) == sorted(map(tuple, rows), key=repr)
    assert mixture.taken_words(mixture.mix_sources(empty)).count() == 0
    assert mixture.mixed_documents(empty).count() == 0
    assert mixture.taken_words(mixture.mix_sources(twice)).count() == 5


def test_targets_share_again_what_small_sources_leave(spark):
    sizes = [(0, 1000, 5), (1, 10, 2), (2, 10, 1), (3, 500, 5), (4, 0, 2)]
    frame = spark.createDataFrame(sizes, "_sid long, _source_size long, _weight int")
    found = {r._sid: r._target for r in mixture._targets(frame, (5, 2, 1), 3).collect()}
    level = (1520 - 60) / 10
    assert found == {0: 5 * level, 1: 30.0, 2: 30.0, 3: 5 * level, 4: 0.0}


def test_each_pass_takes_every_block_once(docs):
    mix = mixture.mix_sources(docs, block_words=4)
    slots = mix.slots.collect()
    assert sorted(s.slot for s in slots) == list(range(len(slots)))
    facts = {r._sid: (r._slots, r._blocks) for r in mix.sources.collect()}
    for sid, (n, blocks) in facts.items():
        times = {}
        for s in slots:
            if s._sid == sid:
                assert 0 <= s._block < blocks
                times[s._block] = times.get(s._block, 0) + 1
        assert sum(times.values()) == n
        if n:
            assert set(times.values()) <= {n // blocks, n // blocks + 1}


def test_mixed_documents_hold_the_words_taken(docs):
    rows = mixture.taken_words(mixture.mix_sources(docs)).collect()
    taken = {r.doc_id: r.taken for r in rows}
    out = mixture.mixed_documents(docs)
    assert out.columns == docs.columns
    got, texts = {}, {r[0]: r[1] for r in ROWS}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(brute.words(r.text))
        assert set(brute.words(r.text)) <= set(brute.words(texts[r.doc_id]))
    assert got == {d: n for d, n in taken.items() if n}


# URLs.


def test_urls(spark, empty):
    links = '<a href="http://bad.net/es/x">x</a> <a HREF=//good.com/a>y</a> <a href="/in">z</a>'
    rows = [
        (1, "https://BAD.net/es/a?q#f", None),
        (2, "http://bad.net/de/a", ""),
        (3, "http://good.com/a", None),
        (4, "http://a.org/x", '<a href="http://bad.net/es/1">1</a>'),
        (5, "http://b.org/x", links),
        (6, None, links),
        (7, "no url", links),
        (8, "http://www.example.com/en/1", None),
        (9, "http://example.com/en/1", None),
        (10, "http://example.com?x=/en/", None),
        (11, "x://y://z/p", None),
        (12, "http://notnet/es/a", None),
        (5, "http://b.org/x", links),
    ]
    frame = spark.createDataFrame(
        [(*r, "odd", "odd") for r in rows], "page_id long, url string, html string, rule string, _host string"
    )
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(frame).collect()}
    assert found == {
        1: ("bad.net", "/es/a", "net/es/", "block"),
        2: ("bad.net", "/de/a", None, "allow"),
        3: ("good.com", "/a", "com/", "allow"),
        4: ("a.org", "/x", None, "allow"),
        5: ("b.org", "/x", None, "allow"),
        6: ("", "", None, "allow"),
        7: ("", "", None, "allow"),
        8: ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        9: ("example.com", "/en/1", "example.com/en/", "block"),
        10: ("example.com", "", None, "allow"),
        11: ("y:", "//z/p", None, "allow"),
        12: ("notnet", "/es/a", None, "allow"),
    }
    # A host whose links alone lead to a host of blocked pages alone is blocked.
    only = frame.filter("page_id NOT IN (2, 5)")
    found = {r.page_id: r.verdict for r in urls.judge_urls(only).collect()}
    assert found[4] == "block"
    assert urls.judge_urls(frame.limit(0)).count() == 0


def test_spread_equals_plain_iteration(spark):
    seeds = [("a", 1.0, 0.0), ("b", 0.0, 1.0), ("c", 0.0, 0.0)]
    links = [("a", "b", 1), ("a", "c", 3), ("c", "b", 2), ("b", "a", 1)]
    found = urls.spread(
        spark.createDataFrame(seeds, "host string, trust double, distrust double"),
        spark.createDataFrame(links, "src string, dst string, links long"),
        steps=7,
    )
    out = {}
    for s, _, n in links:
        out[s] = out.get(s, 0) + n
    start_t, start_d = {"a": 0.15}, {"b": 0.15}
    trust, distrust = dict(start_t), dict(start_d)
    for _ in range(7):
        next_t, next_d = dict(start_t), dict(start_d)
        for s, d, n in links:
            next_t[d] = next_t.get(d, 0) + 0.85 * trust.get(s, 0) * n / out[s]
            next_d[s] = next_d.get(s, 0) + 0.85 * distrust.get(d, 0) * n / out[s]
        trust, distrust = next_t, next_d
    for r in found.collect():
        assert r.trust == pytest.approx(trust.get(r.host, 0))
        assert r.distrust == pytest.approx(distrust.get(r.host, 0))


# Search.


def test_top_k(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.0, 0.5, 1.0, -1.0]) for _ in range(3)]) for i in range(200)]
    rows += [(i, [1.0, 1.0, 1.0]) for i in range(200, 300)]
    rows += [(300, None), (301, [None, 1.0, 1.0]), (302, [float("nan")] * 3), (303, [float("inf")] * 3)]
    rows += [(304, [9.0]), (305, []), (None, [50.0] * 3), rows[0], rows[0]]
    schema = "vec_id long, embedding array<float>, rank string, score string"
    frame = spark.createDataFrame([(*r, "odd", "odd") for r in rows], schema).repartition(3)
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and abs(x) < 100 for x in v):
            good[i] = [int(256 * x // 1) for x in v + [0.0] * (3 - len(v))]
    wanted = []
    for q in good:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(good[q], good[x])), x) for x in good if x != q)
            wanted += [(q, rank, x, -s) for rank, (s, x) in enumerate(scores[:5], 1)]
    query = F.col("vec_id") % 50 == 0
    assert tuples(topk.top_k(frame, query)) == sorted(wanted, key=repr)
    assert tuples(topk.top_k(frame, query, most_pivots=3, per_pivot=1)) == sorted(wanted, key=repr)
    assert topk.top_k(frame.limit(0), query).count() == 0
    assert topk.top_k(frame.filter("vec_id = 50"), query).count() == 0


def test_top_k_of_an_id_with_several_vectors(spark):
    rng = random.Random(9)
    rows = [(0, [100.0 + i, 0.0]) for i in range(8)] + [(50, [0.0, 90.0]), (50, [3.0, 80.0])]
    rows += [(i, [rng.choice([-1.0, 0.5, 1.0]), rng.choice([0.0, 2.0])]) for i in range(1, 40)]
    rows += [(60, [60.0 + i, 1.0]) for i in range(9)]  # one other id cannot fill the ranks
    rows = list(dict.fromkeys((i, tuple(v)) for i, v in rows))
    frame = spark.createDataFrame([(i, list(v)) for i, v in rows], "vec_id long, embedding array<float>")
    whole = [(i, [int(256 * x // 1) for x in v]) for i, v in rows]
    wanted = []
    for q, v in whole:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), x) for x, w in whole if x != q)
            wanted += [(q, rank, x, -s) for rank, (s, x) in enumerate(scores[:5], 1)]
    query = F.col("vec_id") % 50 == 0
    for parts in (1, 3):
        for per_pivot in (1, 64):
            found = topk.top_k(frame.repartition(parts), query, per_pivot=per_pivot)
            assert tuples(found) == sorted(wanted, key=repr)


# Learned operators.


def test_language_and_quality_edges(docs, twice, empty, spark):
    found = language.label_languages(docs, F.lit(True))
    rows = {r.doc_id: (r.lang_pred, r.score) for r in found.collect()}
    assert found.count() == len(ROWS)
    assert [rows[i] for i in (6, 7, 8)] == [("und", 0.0)] * 3
    assert all(0 <= s <= 1 for _, s in rows.values())
    assert language.label_languages(empty, F.lit(True)).count() == 0
    nothing = language.label_languages(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}

    labels = spark.createDataFrame([(1, 1), (10, 0), (5, 1), (1, None), (99, 0)], "doc_id long, quality int")
    scored = quality.score_quality(docs, labels, F.lit(True))
    rows = scored.collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)
    assert quality.score_quality(empty, labels, F.lit(True)).count() == 0
    blank = quality.score_quality(twice, labels.limit(0), F.lit(True)).collect()
    assert {r.score for r in blank} == {0.5}
