"""Parts that need no Spark session."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from kinweave.llm import language, packing, quality, simhash, topk
from kinweave.llm.suffixes import permuted_prefixes, repeated_starts, suffix_array
from kinweave.llm.windows import Powers, anchors, codes, covered, runs
from tests.llm import brute


@given(st.lists(st.integers(1, 4), max_size=60))
def test_suffix_array_and_prefixes(symbols):
    text = symbols + [0]
    array = suffix_array(np.array(text))
    assert array.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    prefixes = permuted_prefixes(np.array(text), array)
    for a, b in zip(array, array[1:]):
        n = 0
        while text[a + n] == text[b + n]:
            n += 1
        assert prefixes[b] == n


@given(st.lists(st.text("ab", min_size=1, max_size=30), min_size=1, max_size=6))
def test_repeated_starts(parts):
    raw = [np.frombuffer(p.encode(), dtype=np.uint8) for p in parts]
    found = repeated_starts(raw, np.ones(len(raw)), 3)
    every = [p[i : i + 3] for p in parts for i in range(len(p) - 2)]
    for part, starts in zip(parts, found):
        wanted = [i for i in range(len(part) - 2) if every.count(part[i : i + 3]) > 1]
        assert starts.tolist() == wanted


def test_a_part_that_counts_twice_repeats_itself():
    found = repeated_starts([np.arange(6), np.arange(9, 12)], np.array([2, 1]), 3)
    assert [f.tolist() for f in found] == [[0, 1, 2, 3], []]


@given(st.binary(min_size=1, max_size=200), st.integers(1, 9), st.integers(1, 7))
def test_anchors_are_leftmost_least(data, short, width):
    raw = np.frombuffer(data, dtype=np.uint8)
    starts = np.arange(max(0, len(raw) - short + 1))
    code = codes(raw, starts, starts + short, Powers())
    for i in starts:
        for j in starts:
            same = data[i : i + short] == data[j : j + short]
            assert same == (code[i] == code[j])
    rank = (code >> np.uint64(24)).tolist()
    found = anchors(code, width)
    wanted = [min(range(i, i + width), key=lambda k: (rank[k], k)) for i in range(len(rank) - width + 1)]
    assert found.tolist() == wanted


def test_covered_and_runs():
    gone = covered(10, np.array([1, 2, 7]), np.array([3, 4, 9]))
    assert np.flatnonzero(gone).tolist() == [1, 2, 3, 7, 8]
    assert [x.tolist() for x in runs(gone)] == [[1, 7], [4, 9]]


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 9), min_size=1, max_size=12))
@settings(deadline=None)
def test_minimum_slack_places_every_piece(counts):
    runs_ = packing.minimum_slack(dict(counts), 40)
    placed, bins = {}, {}
    for r in runs_:
        placed[r.length] = placed.get(r.length, 0) + r.number * r.times
        for b in range(r.bin, r.bin + r.times):
            bins.setdefault(b, []).append((r.offset, r.number * r.length))
    assert placed == counts
    for parts in bins.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= 40


@given(st.dictionaries(st.integers(1, 12), st.integers(1, 3), min_size=1, max_size=5))
def test_fullest_is_the_fullest_with_the_longest(counts):
    used = packing.fullest(counts, 20)
    longest, sums = max(counts), {max(counts)}
    for n, c in counts.items():
        c -= n == longest
        sums = {s + n * k for s in sums for k in range(c + 1) if s + n * k <= 20}
    assert longest in used and all(used[n] <= counts[n] for n in used)
    assert sum(n * k for n, k in used.items()) == max(sums)


@pytest.fixture(scope="module")
def tokenizer_json():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


def test_ids_are_the_tokenizers(tokenizer_json):
    from tokenizers import Tokenizer

    whole, encode = Tokenizer.from_str(tokenizer_json), packing.word_encoder(tokenizer_json)
    texts = [
        "",
        " \t\n",
        "don't Ünïted ÀÉ straße, naïve’s «quoted» x<|endoftext|>y '''s I'LL 1²3",
        "İstanbul ΣΑΣ été é a b 日本 \x01\x7f ª º × ÷ a\x1cb  z",
        "The quick brown fox's 12 tails!!! " * 50,
    ]
    for text in texts:
        wanted = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text.encode()), "<u4").tolist() == wanted


@given(st.text("aB c\t", max_size=40))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) % (1 << 64) == brute.fingerprint(text)


def test_links_of_long_lists_join_what_pairs_join():
    rng = np.random.default_rng(3)
    fps = np.unique(rng.integers(0, 1 << 16, 3000).astype(np.uint64) << np.uint64(48))

    def classes(pairs):
        parent = list(range(len(fps)))
        for i, j in simhash._forest(len(fps), pairs):
            while parent[i] != i:
                i = parent[i]
            while parent[j] != j:
                j = parent[j]
            parent[max(i, j)] = min(i, j)
        return parent

    def roots(parent):
        out = []
        for i in range(len(parent)):
            while parent[i] != i:
                i = parent[i]
            out.append(i)
        return out

    mask = simhash._mask((0, 1, 2, 3, 4, 5))
    assert roots(classes(simhash._pairs(fps))) == roots(classes(simhash._stars(fps, mask)))


def test_marginals_equal_plain_forward_backward():
    rng = np.random.default_rng(0)
    move = rng.normal(size=(3, 3))
    sizes = np.array([1, 5, 64, 65, 200, 3])
    scores = rng.normal(size=(sizes.sum(), 3)) * 2
    found, at, step = language.marginals(scores, sizes, move), 0, np.exp(move)
    for n in sizes:
        like = np.exp(scores[at : at + n])
        ahead, back, now = np.zeros((n, 3)), np.ones((n, 3)), np.full(3, 1 / 3)
        for t in range(n):
            now = (now @ step) * like[t]
            ahead[t] = now = now / now.sum()
        for t in range(n - 2, -1, -1):
            b = step @ (like[t + 1] * back[t + 1])
            back[t] = b / b.sum()
        both = ahead * back
        assert np.allclose(both / both.sum(axis=1, keepdims=True), found[at : at + n])
        at += n


def test_language_field_learns_switches(spark):
    rows = [("the cat and the dog " * 20, "en"), ("le chat et la souris " * 20, "fr"), ("12", "no")]
    docs = spark.createDataFrame(rows, "text string, lang string").withColumn("id", F.lit(1))
    field = language.train(*language.sample(docs, F.lit(True), "id", "text", "lang"))
    assert field.labels == ["en", "fr"]  # a label without a letter is not learned
    labels, scores = language.predict(["the dog", "la souris et", None, "", "123 !?", "☃"], field)
    assert labels == ["en", "fr", "und", "und", "und", "und"]
    assert all(0 <= s <= 1 for s in scores) and scores[2] == 0
    mixed = language.predict(["the cat and the dog and the cat le chat"], field)[0]
    assert mixed == ["en"]
    long = "the dog " * 200_000
    assert language.predict([long], field)[0] == ["en"]
    assert language.train(*language.sample(docs.limit(0), F.lit(True), "id", "text", "lang")) is None
    assert language.predict(["text"], None) == (["und"], [0.0])


def test_language_update_follows_the_slope():
    """One update moves every weight by the sign of the likelihood's slope, by finite steps."""
    rng = np.random.default_rng(2)
    buf = language._buffer("the cat le chat and et dog la souris the dog")
    starts, ends = language._bounds(buf)
    truth = np.array([[0, 0, 1, 1, 0, 1, 0, 1, 1, 0, 0]])
    weights = rng.normal(size=(language.BUCKETS + language.LEXICON, 2)) * 0.1
    moves = rng.normal(size=(2, 2))

    def loss(weights, moves):
        field = language.Field(["a", "b"], weights, moves)
        scores = field.emissions(buf)
        gold = scores[np.arange(11), truth[0]].sum() + moves[truth[0][:-1], truth[0][1:]].sum()
        ahead = scores[0]
        for row in scores[1:]:
            ahead = np.logaddexp.reduce(ahead[:, None] + moves, axis=0) + row
        return np.logaddexp.reduce(ahead) - gold

    learner = language.Learner(weights.copy(), moves.copy(), np.ones(2))
    learner._update(buf, starts, ends, truth)
    step = learner.weights - weights
    spots = np.argwhere(np.abs(step) > 0.02)
    assert len(spots) > 20
    for spot in map(tuple, spots[:: len(spots) // 20]):
        nudged = weights.copy()
        nudged[spot] += 1e-4
        assert np.sign(loss(weights, moves) - loss(nudged, moves)) == np.sign(step[spot])
    for spot in np.ndindex(2, 2):
        nudged = moves.copy()
        nudged[spot] += 1e-4
        change = learner.transitions[spot] - moves[spot]
        assert np.sign(loss(weights, moves) - loss(weights, nudged)) == np.sign(change)


def test_chunks_cover_the_text():
    for n in (0, 1, 255, 256, 257, 448, 449, 5000):
        text = bytes(1 + i % 250 for i in range(n))
        chunks = quality.chunked(text)
        flat = b"".join(c[: quality.HOP].tobytes() for c in chunks[:-1]) + chunks[-1].tobytes()
        assert flat[:n] == text and not any(flat[n:])


def test_network_gradient_is_the_slope():
    rng = np.random.default_rng(5)
    docs = [quality.chunked(rng.integers(1, 255, n).astype(np.uint8).tobytes()) for n in (90, 700, 300)]
    labels = np.array([0, 1, 1])
    net = quality.train(docs[:1], labels[:1], 0.5)
    net.out = rng.normal(size=net.out.shape)
    for name in vars(net):
        setattr(net, name, getattr(net, name).astype(np.float64))
    sizes = np.array(list(map(len, docs)))
    first, chunks = np.cumsum(sizes) - sizes, np.concatenate(docs)

    def loss():
        p = quality.score_texts(net, [])
        combined = quality._combined(quality.pooled(net, chunks), first, sizes)
        logit = quality._logits(net, combined)[1]
        return float(np.mean(np.log1p(np.exp(logit)) - labels * logit)) + float(p.sum())

    grad = quality._gradient(net, chunks, first, sizes, labels)
    for name in vars(net):
        weights = getattr(net, name)
        spot = np.unravel_index(np.abs(grad[name]).argmax(), weights.shape)
        kept, eps = weights[spot], 1e-5
        weights[spot] = kept + eps
        above = loss()
        weights[spot] = kept - eps
        below = loss()
        weights[spot] = kept
        assert (above - below) / (2 * eps) == pytest.approx(grad[name][spot], rel=2e-2, abs=1e-6)


def test_one_label_only_answers_with_it():
    net = quality.train([quality.chunked(b"x")], np.array([1]), 0.5)
    assert quality.score_texts(net, [b"", b"any"]).min() > 0.9
    assert quality.score_texts(quality.train([], np.zeros(0), 0.5), [b"a"]).tolist() == [0.5]


def test_products_beyond_a_double_are_exact():
    q, x = np.array([[1 << 40, 3]]), np.array([[1 << 20, 1], [1 << 40, 0]])
    assert topk._scores(q, x).tolist() == [[(1 << 60) + 3, (1 << 63) - 1]]
