"""Personal data, conversation repair and vector codes: plain versions, odd values, empty tables."""

import hashlib
import heapq
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from kinweave.llm import codes, language, mixture, personal, queries, repair, urls
from kinweave.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
ODD = "spans string, _text string, _row string, _conv string, _id string, _label string, code string"
ODD_VALUES = tuple("odd" for _ in ODD.split(","))


def tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


# Personal data.

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), rank, m.end(), kind))
    return sorted(found)


TEXTS = [
    "mail a.b+c@x-y.example.com, or _x@y.z_q@r.s.t! a@b.c.@d.e",
    "a@b c@d.e@f.g %@%.x 1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.0004 1.2.3",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 and 5500000000000004 x",
    "+1 (743) 555-3824 then +49 30 1234567890123456 and +12 and +1----------2 +1 2",
    "日本 😀 x@y.zz 😀 10.0.0.1 é",
    "my SSN is 123-45-6789. order 123-45-6789, ssn 1123-45-6789",
    "call (555) 123-4567 or tel 555.123.4567; part 555-123-4567",
    "IBAN DE89370400440532013000 or GB82 WEST 1234 5698 7654 32. DE89370400440532013001",
    "",
    None,
    "no personal data here",
    "7" * 50_000 + " " + "a." * 30_000 + "@ " + "z" * 50_000 + "@b.c " + "1." * 20_000,
    "x@y.z " * 3000 + "+12345678901 " * 1500,
    "+1" + " " * 20_000,
]


@pytest.fixture(scope="module")
def personal_rows(spark):
    rows = [(i, t, *ODD_VALUES) for i, t in enumerate(TEXTS)] + [(None, "a@b.cd", *ODD_VALUES)] * 2
    return spark.createDataFrame(rows, f"doc_id long, text string, {ODD}")


def test_base_spans_equal_plain_search(personal_rows):
    names = list(PLAIN)
    found = personal.find_personal(personal_rows)
    assert found.columns == [c for c in personal_rows.columns if c != "spans"] + ["spans"]
    rows = found.collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        got = [(s.start, s.rank, s.end, s.kind) for s in r.spans if s.kind in names]
        assert got == base_spans(r.text), r.doc_id
        assert all(0 <= s.score <= 1 for s in r.spans)


def test_added_spans_need_checks_and_context(personal_rows):
    found = {r.doc_id: r for r in personal.find_personal(personal_rows).collect()}

    def added(doc_id):
        row = found[doc_id]
        return [(s.kind, row.text[s.start : s.end]) for s in row.spans if s.kind not in PLAIN]

    assert added(5) == [("national_id", "123-45-6789")]
    assert added(6) == [("local_phone", "(555) 123-4567"), ("local_phone", "555.123.4567")]
    assert added(7) == [("iban", "DE89370400440532013000"), ("iban", "GB82 WEST 1234 5698 7654 32")]
    assert not any(added(i) for i in (0, 1, 2, 3, 4, 8, 9, 10, 12))


def test_personal_edges(personal_rows):
    assert personal.find_personal(personal_rows.limit(0)).count() == 0
    twice = [r.spans for r in personal.find_personal(personal_rows).filter("doc_id IS NULL").collect()]
    assert len(twice) == 2 and twice[0] == twice[1] and len(twice[0]) == 1


def test_personal_uses_no_python_workers(spark):
    plan = QUERIES["op11_personal_data"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


# Conversation repair.


def plain_repair(rows):
    """[(conv, turn, role, text)] -> {conv: result}; cheapest edits by Dijkstra's search."""
    convs = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        what = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        kept = convs.setdefault(conv, [])
        if what == 0:
            continue
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        role = "user" if what == 4 else role
        digest = hashlib.sha256(text.encode()).digest()
        kept += [((turn is not None, turn or 0), role, digest, text, turn)] * (2 if what == 3 else 1)
    return {conv: _repair(sorted(kept, key=lambda r: r[:3])) for conv, kept in convs.items()}


def _repair(rows):
    faults, seen = [], set()
    for _, role, _, text, _ in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = None
        if not solid:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif solid[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        faults.append(fault)
    turns = {r[4] for r in rows if r[4] is not None}
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, last, lines = heapq.heappop(heap)
        if at == len(rows) and last in ("", "a"):
            break
        if (at, last) in done:
            continue
        done.add((at, last))
        for goal in follow[last]:
            if goal in names:
                heapq.heappush(heap, (cost + 5, audit + "I", at, goal, (*lines, f"{names[goal]}:")))
        if at == len(rows):
            continue
        _, role, _, text, _ = rows[at]
        heapq.heappush(heap, (cost + 2, audit + "D", at + 1, last, lines))
        if faults[at] in ("blank", "duplicate"):
            continue
        extra = 5 * (faults[at] == "truncated")
        for goal in follow[last]:
            if role[:1] == goal:
                step = (cost + extra, audit + "K", at + 1, goal, (*lines, f"{role}:{text}"))
                heapq.heappush(heap, step)
            if goal in names:
                line = f"{names[goal]}:{text}"
                heapq.heappush(heap, (cost + extra + 1, audit + "R", at + 1, goal, (*lines, line)))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, *counts, illegal, cost, audit, digest)


def made_conversations():
    rng = random.Random(3)
    rows = []
    for conv in range(150):
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rng.choice(["Hi.", "yes!", "cut off", "", "  \n", "Why?  ", None, "é 日."])
            rows.append((conv, None if rng.random() < 0.1 else turn + rng.randrange(3), role, text))
    rows += [(None, t, "user", f"null {t}.") for t in range(4)]
    rows += [(1000, t, "user" if t % 2 else "assistant", f"turn {t // 7}.") for t in range(600)]
    return rows + rows[:40]


CONVERSATION = "conv_id long, turn int, role string, text string"


def test_repair_equals_plain_search(spark):
    rows = made_conversations()
    frame = spark.createDataFrame([(*r, *ODD_VALUES) for r in rows], f"{CONVERSATION}, {ODD}")
    found = repair.repair_conversations(frame.repartition(5)).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == plain_repair(rows)
    assert len(found) == len({r[0] for r in rows})
    # Deleting costs less than inserting wherever these costs hold.
    assert set("DKR") == set("".join(r.audit for r in found))


def test_repair_edges(spark):
    frame = spark.createDataFrame([], CONVERSATION)
    assert repair.repair_conversations(frame).count() == 0
    # A conversation all of whose rows are dropped.
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    gone = spark.createDataFrame([(conv, 0, "user", "x.")], CONVERSATION)
    blank = hashlib.sha256(b"").hexdigest()
    assert tuples(repair.repair_conversations(gone)) == [(conv, 0, 0, 0, 0, 0, 0, "", blank)]


def test_automaton_shares_ends():
    rng = random.Random(5)
    signatures = sorted({"".join(rng.choice("suaoUAx") for _ in range(rng.randrange(9))) for _ in range(400)})
    together = repair.Automaton()
    made = 0
    add = together._add

    def counted(best):
        nonlocal made
        made += 1
        add(best)

    together._add = counted
    reverses = sorted(s[::-1] for s in signatures)
    shared = [together.audit(r) for r in reverses]
    assert shared == [repair.Automaton().audit(r) for r in reverses]
    ends = {s[i:] for s in signatures for i in range(len(s))}
    assert made == len(ends)  # one node for each end, the empty one was there


def test_repair_sorts_one_partitioning(spark):
    frame = spark.createDataFrame(made_conversations()[:50], CONVERSATION)
    whole = repair.damaged(frame, "conv_id", "turn", "role", "text")
    plan = repair.conversations(whole)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


# Vector codes.


def plain_codes(rows, rounds=6):
    """[(id, vector, label)] with different ids -> codes, errors, books by plain numpy."""
    good = [
        (i, [int(np.clip(np.floor(4096 * np.float64(np.float32(x))), -codes.MOST, codes.MOST)) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    width = max(1, -(-max(len(v) for _, v, _ in good) // 8))
    good = [(i, v + [0] * (8 * width - len(v)), label) for i, v, label in good]
    data = np.array([v for _, v, _ in good]).reshape(-1, 8, width)
    first = sorted(range(len(good)), key=lambda n: (good[n][0] is None, good[n][0]))[:16]
    books = data[first].transpose(1, 0, 2).copy()

    def assign(pos):
        gaps = ((data[:, pos, None, :] - books[pos][None]) ** 2).sum(axis=2)
        return gaps.argmin(axis=1), gaps.min(axis=1)

    for _ in range(rounds):
        for pos in range(8):
            code, _ = assign(pos)
            for k in np.unique(code):
                mine = data[code == k, pos]
                books[pos, k] = [sum(map(int, col)) // len(mine) for col in mine.T]
    found = [assign(pos) for pos in range(8)]
    errors = sum(d for _, d in found)
    by_label = {}
    for (_, _, label), e in zip(good, errors):
        by_label[label] = by_label.get(label, 0) + int(e)
    text = ",".join(str(x) for x in books.ravel())
    out = {
        i: ("".join(f"{found[p][0][n]:02x}" for p in range(8)), int(errors[n]), by_label[label])
        for n, (i, _, label) in enumerate(good)
    }
    return out, hashlib.sha256(text.encode()).hexdigest()


def coded(frame):
    found, books = codes.compress(frame)
    rows = {r.vec_id: (r.code, r.error, r.label_error) for r in found.collect()}
    return rows, codes.books_digest(books), found


VECTORS = f"vec_id long, embedding array<float>, label int, {ODD}"


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, *ODD_VALUES) for r in rows], VECTORS).repartition(3)


def test_codes_equal_plain_rounds(spark):
    rng = random.Random(6)
    near = [-0.5, 0.0, 0.25, 0.3, 1.0]
    rows = [(i, [rng.choice(near) for _ in range(24)], rng.choice([0, 1, None])) for i in range(5, 400)]
    rows += [(i, [0.0] * 24, 7) for i in range(400, 600)]  # a third hold one vector
    rows += [(i, [rng.gauss(0, 1) for _ in range(24)], 8) for i in range(600, 700)]
    rows += [(0, None, 1), (1, [None] * 24, 1), (2, [float("nan")] * 24, 1), (3, [float("-inf")] * 24, 1)]
    rows += [(None, [0.1] * 24, None), (4, [100000.0] + [-3.0] * 23, 9)]
    got, digest, found = coded(frame_of(spark, rows))
    wanted, wanted_digest = plain_codes(rows)
    assert digest == wanted_digest and got == wanted
    assert found.columns == ["vec_id", "label", "code", "error", "label_error"]


def test_codes_of_few_odd_and_repeated_vectors(spark):
    rows = [(1, [1.0, 2.0, 3.0], 1), (2, [0.5] * 11, 1), (3, [], None)]
    got, digest, _ = coded(frame_of(spark, rows))
    assert (got, digest) == plain_codes(rows)
    _, _, found = coded(frame_of(spark, rows[:2] * 3))
    assert found.count() == 6
    for nothing in ([], [(1, None, 2)]):
        found, books = codes.compress(frame_of(spark, nothing))
        assert found.count() == 0 and codes.books_digest(books) == hashlib.sha256(b"").hexdigest()


def test_trie_walks_depth_first_in_blocks(monkeypatch):
    monkeypatch.setattr(codes, "BLOCK_NODES", 3)
    rng = np.random.default_rng(1)
    parts = np.unique(rng.integers(-2, 3, (300, 4)), axis=0)
    entries = rng.integers(-3, 4, (5, 4))
    stretches = [where for where, _ in codes.Trie(parts).leaves(entries)]
    assert [w.start for w in stretches] == [0, *(w.stop for w in stretches[:-1])]
    code, distance = codes.Trie(parts).nearest(entries)
    gaps = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (code == gaps.argmin(axis=1)).all() and (distance == gaps.min(axis=1)).all()


def test_common_part_is_shuffled_once_a_group(spark):
    rows = [(i, [0.0] * 16 if i % 3 else [i / 7.0] * 16, 1) for i in range(900)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    vecs = codes.quantised(frame.coalesce(1), "vec_id", "embedding", "label")
    parts = codes.distinct_parts(vecs, 2).collect()
    assert sum(r.weight for r in parts) == 900 * 8
    assert len(parts) == 8 * 300  # id 0 holds 0.0 as well


# Language of many labels, whatever the partitioning.


def made_languages(n_labels, docs, n_words):
    rng = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyzäöüéèçñ"
    rows = []
    for k in range(n_labels):
        own = rng.sample(letters, 12)
        words = ["".join(rng.choice(own) for _ in range(rng.randrange(2, 9))) for _ in range(150)]
        for d in range(docs):
            text = " ".join(rng.choice(words) for _ in range(rng.randrange(n_words // 2, n_words)))
            rows.append((k * docs + d, text, f"l{k:02d}"))
    return rows


def test_language_of_forty_labels_in_a_minute(spark):
    rows = made_languages(40, 25, 120)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    start = time.perf_counter()
    found = language.label_languages(docs, F.col("doc_id") % 4 != 1, keep=["doc_id", "lang"])
    held = [r for r in found.collect() if r.doc_id % 4 == 1]
    assert time.perf_counter() - start < 60
    assert sum(r.lang == r.lang_pred for r in held) > 0.95 * len(held) > 200


def test_language_scores_do_not_depend_on_the_partitioning(spark):
    rows = made_languages(3, 40, 60)
    rows += [(None, t, k) for _, t, k in rows[:9]] + rows[:30] + [(rows[0][0], "other words", "l01")]
    rows += [(1000, None, "l00"), (1001, "", "l00"), (1002, "12 34", "l01"), (1003, "abc", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    fold = F.coalesce(F.col("doc_id") % 3, F.lit(0)) != 1
    one = language.label_languages(docs.coalesce(1), fold)
    many = language.label_languages(docs.orderBy(F.xxhash64("text").desc()).repartition(7), fold)
    assert tuples(one) == tuples(many)


def test_rows_without_an_id_are_not_held_out(spark):
    row = spark.createDataFrame([(None,), (1,)], "doc_id long")
    for divisor, fold in ((3, 1), (4, 2)):
        found = row.select((queries._remainder(divisor) == fold).alias("held")).collect()
        assert found[0].held is False and found[1].held is (zlib.crc32(b"1") % divisor == fold)


# Distrust reaches a host by its own links, however many others link to the same bad host.


@pytest.mark.parametrize("linkers", [1, 2, 20, 1000])
def test_distrust_is_not_thinned_out(spark, linkers):
    to = '<a href="http://{}/x">1</a>'.format
    rows = [(f"http://bad.net/{lang}/{n}", None) for lang in ("es", "fr") for n in range(3)]
    rows += [("http://good.com/1", None), ("http://plain.org/1", None)]
    rows += [(f"http://l{n}.org/1", to("bad.net")) for n in range(linkers)]
    rows += [(f"http://half{n}.org/1", to("bad.net") + to("plain.org")) for n in range(3)]
    rows += [("http://far.org/1", to("l0.org")), ("http://fine.org/1", to("good.com") + to("plain.org"))]
    frame = spark.createDataFrame(rows, "url string, html string").withColumn("page_id", F.lit(1))
    found = {r.host: r.verdict for r in urls.judge_urls(frame).collect()}
    assert all(found[f"l{n}.org"] == "block" for n in range(linkers))
    assert found["far.org"] == found["bad.net"] == "block"
    clean = ["good.com", "plain.org", "fine.org", *(f"half{n}.org" for n in range(3))]
    assert [found[host] for host in clean] == ["allow"] * len(clean)


def test_distrust_equals_sql_on_a_planted_graph(spark):
    rng = random.Random(12)
    ends = ["net", "com", "org", "org"]
    hosts = [f"h{n}.{ends[n % 4]}" for n in range(60)]
    rows = []
    for page in range(900):
        n = rng.randrange(60)
        own = hosts[n]
        # Half of the free hosts link to each other and to trusted ones, the rest to all.
        goals = rng.choices(hosts[1::4] + hosts[2::4] if n % 4 == 2 else hosts, k=rng.randrange(4))
        html = "".join(f'<a href="http://{g}/a">x</a>' for g in goals)
        rows.append((page, f"http://{own}/{rng.choice(['es', 'fr', 'es'])}/{page}", html))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    con = duckdb.connect()
    con.register("pages", pages.toArrow())
    wanted = con.execute(SQL["op2_url_filters"])
    columns = [c[0] for c in wanted.description]
    found = urls.judge_urls(pages).select(*columns)
    assert tuples(found) == sorted(wanted.fetchall(), key=repr)
    free = [r.verdict for r in found.filter("rule IS NULL").collect()]
    assert 0.05 * len(free) < free.count("block") < 0.95 * len(free)


# The mix over other splits of the input.


def test_mix_of_repeated_and_missing_ids_over_other_splits(spark):
    rng = random.Random(3)
    rows = []
    for n in range(400):
        text = " ".join(rng.choice("ab cd ef gh ij".split()) for _ in range(rng.randrange(40)))
        rows.append((rng.choice([None, n % 50, n]), rng.choice([None, "", text]) if n % 9 == 0 else text,
                     rng.choice([None, "a", "a", "b", "c"])))
    rows += rows[:20]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one = mixture.taken_words(mixture.mix_sources(docs.coalesce(1)))
    many = mixture.taken_words(mixture.mix_sources(docs.orderBy(F.xxhash64("text", "source")).repartition(9)))
    assert tuples(one) == tuples(many)


def test_mix_as_registered(spark):
    """Sizes and targets by SQL on the whole table, words taken near each source's target."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    wanted = con.execute("""
        WITH d AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''),
            '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS size FROM documents)
        SELECT doc_id, size, sum(size) OVER (PARTITION BY source) AS source_size, source FROM d
    """).fetchall()
    rows = {r.doc_id: r for r in QUERIES["op6_mix_sources"](spark, SF_DIR).collect()}
    assert len(rows) == len(wanted)
    sizes = {source: int(total) for _, _, total, source in wanted}
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, targets, free = sum(sizes.values()), {}, set(names)
    while free:
        left = total - sum(targets.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        targets |= {s: 3 * sizes[s] for s in over} if over else share
        free = free - over if over else set()
    taken = dict.fromkeys(names, 0)
    for doc_id, size, source_size, source in wanted:
        row = rows[doc_id]
        assert (row["size"], row.source_size) == (size, source_size)
        assert row.target == pytest.approx(targets[source])
        assert 0 <= row.taken <= 3 * size
        taken[source] += row.taken
    assert all(abs(taken[s] - targets[s]) <= 2 * mixture.BLOCK_WORDS for s in names)
    again = {r.doc_id: r.taken for r in QUERIES["op6_mix_sources"](spark, SF_DIR).collect()}
    assert again == {doc_id: r.taken for doc_id, r in rows.items()}


# Packing as registered.


def test_packing_as_registered(spark):
    """Every piece of every document once, its ids those of the tokenizer, gapless sequences."""
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = QUERIES["op5_best_fit_packing"](spark, SF_DIR).collect()
    pieces, sequences = {}, {}
    for r in rows:
        assert (r.doc_id, r.piece) not in pieces
        pieces[r.doc_id, r.piece] = (r.start, r.length, r.ids_crc32)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    wanted = {}
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], "<u4")
            wanted[r.doc_id, piece] = (at, len(part), zlib.crc32(part.tobytes()))
    assert pieces == wanted
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    # Equally full combinations can differ, so the plain version may need a few more or fewer.
    sizes = [n for _, n, _ in wanted.values()]
    assert -(-sum(sizes) // 2048) <= len(sequences) <= plain_slack(sizes, 2048) + 1


def plain_slack(sizes, capacity):
    """Number of bins when each takes the fullest combination of the pieces that are left."""
    left, bins = Counter(sizes), 0
    while left:
        reach = [0] * (capacity + 1)
        sums = 1
        kinds = sorted(left, reverse=True)
        for size in kinds:
            before = sums
            for _ in range(min(left[size], capacity // size)):
                sums |= (sums << size) & ((1 << (capacity + 1)) - 1)
            reach[size] = before
        at = sums.bit_length() - 1
        for size in reversed(kinds):
            while not reach[size] >> at & 1:
                at -= size
                left[size] -= 1
        left = +left
        bins += 1
    return bins
