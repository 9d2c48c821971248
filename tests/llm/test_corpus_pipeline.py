"""The pipeline: each stage against a plain version on its own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kinweave.llm import language
from kinweave.session import materialise
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], SF_DIR), f"test-{name}"))
    return [frame.collect() for frame in out], [frame.columns for frame in out]


def test_columns(steps):
    _, columns = steps
    assert all(c == columns[0] for c in columns[:-1])


def test_stages(steps):
    (raw, known, single, distinct, mix, packed), _ = steps
    assert known and {r.doc_id for r in known} <= {r.doc_id for r in raw}
    assert all(any(c.isalpha() for c in r.text) for r in known)
    assert len(known) >= 0.97 * len([r for r in raw if any(c.isalpha() for c in r.text or "")])
    kept = {k for _, k, _, _ in brute.exact([(r.doc_id, r.text) for r in known])}
    assert {r.doc_id for r in single} == kept and len(single) == len(kept)
    first = {c for _, _, c in brute.near([(r.doc_id, r.text) for r in single])}
    assert sorted(r.doc_id for r in distinct) == sorted(first)
    size = {r.doc_id: len(brute.words(r.text)) for r in distinct}
    taken = {}
    for r in mix:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(brute.words(r.text))
        assert r.n_chars == len(r.text)
    assert all(0 < n <= 3 * size[d] for d, n in taken.items())
    assert sum(taken.values()) == pytest.approx(sum(size.values()), rel=0.02)
    assert {r.doc_id for r in packed} == set(taken)
    assert sum(r.piece == 0 for r in packed) == len(mix)


def test_language_keeps_every_lettered_document(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    words = {}
    for r in docs.filter("text IS NOT NULL AND lang IS NOT NULL").orderBy("doc_id").collect():
        words.setdefault(r.lang, []).extend(brute.words(r.text)[:40])
    langs = sorted(words)[:3]
    shares = [(10, 9, 8), (16, 14, 10), (9, 9, 9), (40, 35, 25)]
    texts = [
        " ".join(w for lang, n in zip(langs, parts) for w in words[lang][at : at + n])
        for at in (0, 50, 100)
        for parts in shares
    ]
    texts += [w for lang in langs for w in words[lang] if any(map(str.isalpha, w))]
    odd = [None, "", "12 34 !", " \n"]
    # Without a label, so that nothing is learned from them.
    extra = spark.createDataFrame(
        [(10**9 + i, t) for i, t in enumerate(texts + odd)], "doc_id long, text string"
    )
    both = docs.unionByName(extra, allowMissingColumns=True)
    kept = {r.doc_id for r in corpus_pipeline.known_language(spark, both, SF_DIR).collect()}
    lettered = {r.doc_id for r in both.collect() if any(map(str.isalpha, r.text or ""))}
    assert kept == lettered
    scored = language.label_languages(both, F.col("lang").isNotNull())
    mixed = scored.filter(F.col("doc_id").between(10**9, 10**9 + 3 * len(shares) - 1))
    assert sum(r.score < 0.5 for r in mixed.collect()) >= len(shares)


def test_run_and_empty(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0
