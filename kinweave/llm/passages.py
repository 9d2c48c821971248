"""Removal of repeated passages: word windows doubled level by level."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm import repeats
from kinweave.llm.repeats import KEY
from kinweave.llm.windows import Powers, anchors, codes, covered, runs
from kinweave.session import materialise

# Words of a window, and of the windows of half the length that are looked at first.
WINDOW = 20
SHORT = WINDOW // 2
# Short windows in a window.
WIDTH = WINDOW - SHORT + 1


class Words:
    """A text's words in one byte string, with their bounds."""

    def __init__(self, text: bytes):
        words = text.split()
        self.n = len(words)
        self.plain = b" ".join(words)
        self.data = np.frombuffer(self.plain, dtype=np.uint8)
        blanks = np.flatnonzero(self.data == 32)
        self.starts = np.concatenate(([0], blanks + 1))[: self.n]
        self.ends = np.append(blanks, len(self.plain))[: self.n]

    def codes(self, at: np.ndarray, length: int, powers: Powers) -> np.ndarray:
        return codes(self.data, self.starts[at], self.ends[at + length - 1], powers)

    def anchors(self, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all short windows, and for each window the place of its anchor."""
        if self.n < WINDOW:
            none = np.zeros(0, dtype=np.int64)
            return none.astype(np.uint64), none
        code = self.codes(np.arange(self.n - SHORT + 1), SHORT, powers)
        return code, anchors(code, WIDTH)


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _described(powers: Powers):
    def work(text: bytes):
        words = Words(text)
        code, anchor = words.anchors(powers)
        places = np.unique(anchor)
        return words.n, _sha(words.plain), code[places], places

    return work


def _long(powers: Powers):
    """(k1, k2, start, stop) of the windows whose short window is repeated.

    A window that begins for the first time in its text has its digest. Those that repeat an
    earlier one of the same text go anyway; they come as stretches without a digest.
    """

    def work(text: bytes, at: np.ndarray):
        words = Words(text)
        _, anchor = words.anchors(powers)
        start = np.flatnonzero(np.isin(anchor, at))
        digests = b"".join(
            xxhash.xxh3_128_digest(words.plain[s:e])
            for s, e in zip(
                words.starts[start].tolist(), words.ends[start + WINDOW - 1].tolist()
            )
        )
        keys = np.frombuffer(digests, dtype="<i8").reshape(-1, 2)
        _, first = np.unique(keys, axis=0, return_index=True)
        again = np.ones(len(start), dtype=bool)
        again[first] = False
        begin, end = runs(covered(words.n, start[again], start[again] + WINDOW))
        first.sort()
        none = pa.nulls(len(begin), pa.int64())
        return (
            pa.concat_arrays([pa.array(keys[first, 0]), none]),
            pa.concat_arrays([pa.array(keys[first, 1]), none]),
            np.concatenate([start[first], begin]),
            np.concatenate([start[first] + WINDOW, end]),
        )

    return work


def _cut(text: bytes, starts: np.ndarray, stops: np.ndarray):
    """(number of words removed, SHA-256 of the words kept)."""
    words = Words(text)
    gone = covered(words.n, starts, stops)
    kept = np.flatnonzero(~gone)
    plain = b" ".join(
        words.plain[s:e]
        for s, e in zip(words.starts[kept].tolist(), words.ends[kept].tolist())
    )
    return [int(gone.sum())], [_sha(plain)]


def remove_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of every row.

    A word goes if a window of 20 words over it also starts earlier: in a smaller id (NULL
    ids last, rows of one id by a hash of their texts), or earlier in the same text. Windows
    are judged on the input. Rows equal in id and text are one document, so none of them
    takes words from the other; NULL and empty texts have no words; an empty input gives no
    rows; other columns are left out.

    A window of 20 words is repeated only if the windows of 10 in it are. So windows of 10 are
    counted, and those repeated alone are extended to 20, where nothing is left to double. A
    window is looked at through one short window in it, the one with the least code, which
    equal windows choose alike: one place in six enters the first level. Codes only rule
    out; the last level compares 128-bit digests of the words themselves. Documents equal as
    a whole are found first, and only the first of them is searched.
    """
    rows = repeats.keyed(docs, id_col, text_col)
    powers = Powers()
    facts = repeats.described(rows, _described(powers), "passages-facts")
    single = repeats.one_per_key(facts)
    firsts = materialise(repeats.copies(single), "passages-copies")
    found = repeats.candidates(rows, facts, firsts, "passages-texts")
    texts = repeats.one_per_key(found)

    long = materialise(
        repeats.mapped(texts, _long(powers), ["_at"], "k1 long, k2 long, start long, stop long"),
        "passages-windows",
    )
    place = F.struct(F.col("_id").isNull().alias("_null"), "_id", "_h", "start")
    windows = long.filter("k1 IS NOT NULL")
    first = materialise(
        windows.groupBy("k1", "k2")
        .agg(F.min(place).alias("_place"), F.count(F.lit(1)).alias("_times"))
        .filter("_times > 1")
        .drop("_times"),
        "passages-first",
    )
    later = windows.join(first, ["k1", "k2"]).filter(~place.eqNullSafe(F.col("_place")))
    span = F.struct("start", "stop")
    spans = materialise(
        later.select(*KEY, "start", "stop")
        .unionByName(long.filter("k1 IS NULL").select(*KEY, "start", "stop"))
        .groupBy(*KEY)
        .agg(F.collect_list(span).alias("_spans"))
        .select(*KEY, F.col("_spans.start").alias("_starts"), F.col("_spans.stop").alias("_stops")),
        "passages-spans",
    )
    cut = repeats.mapped(
        repeats.join_key(texts, spans),
        _cut,
        ["_starts", "_stops"],
        "n_removed long, kept_sha256 string",
    )

    first_of = firsts.select("_sha", F.col("_id").alias("_id1"), F.col("_h").alias("_h1"))
    is_first = F.col("_id").eqNullSafe(F.col("_id1")) & (F.col("_h") == F.col("_h1"))
    whole = ~is_first & (F.col("_n") >= WINDOW)
    joined = repeats.join_key(
        facts.select(*KEY, "_n", "_sha").join(first_of, "_sha"), cut, "left"
    )
    return joined.select(
        F.col("_id").alias(id_col),
        F.col("_n").alias("n_words"),
        F.when(whole, F.col("_n")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(_sha(b"")))
        .otherwise(F.coalesce("kept_sha256", "_sha"))
        .alias("kept_sha256"),
    )
