"""Removal of repeated byte strings: suffix arrays over the stretches that can repeat."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm import repeats
from kinweave.llm.repeats import KEY
from kinweave.llm.suffixes import repeated_starts
from kinweave.llm.windows import Powers, anchors, codes, covered, runs
from kinweave.session import materialise

# Bytes of a string that counts, and of the short string that stands for it.
WINDOW, SHORT = 200, 32
WIDTH = WINDOW - SHORT + 1
# What a stretch shows beyond its short string on one side: half of the rest.
SIDE = (WINDOW - SHORT) // 2
# Bytes of a stretch's key, which stand as one symbol in a suffix array.
KEY_SIZE = SHORT + SIDE
# Bytes of one suffix array, and of one key beyond which its strings are counted by digest.
SHARD_BYTES = 1 << 18
KEY_BYTES = 1 << 20


def _described(powers: Powers):
    def work(text: bytes):
        code, anchor = _anchors(text, powers)
        places = np.unique(anchor)
        return len(text), hashlib.sha256(text).hexdigest(), code[places], places

    return work


def _anchors(text: bytes, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    if len(text) < WINDOW:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none
    data = np.frombuffer(text, dtype=np.uint8)
    starts = np.arange(len(data) - SHORT + 1)
    code = codes(data, starts, starts + SHORT, powers)
    return code, anchors(code, WIDTH)


def _stretches(powers: Powers):
    """(code, d1, d2, key, start, stop) of the stretches around anchors.

    Windows with one anchor begin in a row. Those that show 84 bytes before it form a stretch
    keyed by these bytes and the anchor's, the others one keyed by the 84 after it; ``key`` is
    where that begins. The digest is of the stretch's bytes.
    """

    def work(text: bytes, at: np.ndarray):
        data = np.frombuffer(text, dtype=np.uint8)
        _, anchor = _anchors(text, powers)
        at = np.unique(at)
        first, last = np.searchsorted(anchor, at), np.searchsorted(anchor, at, side="right") - 1
        split = np.maximum(first, at - SIDE)
        late, early = split <= last, first < split
        starts = np.concatenate([split[late], first[early]])
        stops = WINDOW + np.concatenate([last[late], np.minimum(split - 1, last)[early]])
        code = np.concatenate(
            [
                codes(data, at[late], at[late] + KEY_SIZE, powers),
                ~codes(data, at[early] - SIDE, at[early] + SHORT, powers),
            ]
        )
        key = np.concatenate([at[late], at[early] - SIDE]) - starts
        digests = b"".join(
            xxhash.xxh3_128_digest(text[a:b]) for a, b in zip(starts.tolist(), stops.tolist())
        )
        keys = np.frombuffer(digests, dtype="<i8").reshape(-1, 2)
        return code.view(np.int64), keys[:, 0].copy(), keys[:, 1].copy(), key, starts, stops

    return work


def _bytes(text: bytes, codes_, d1, d2, weights, keys, starts, stops):
    """(code, d1, d2, weight, key, bytes) of the stretches named."""
    parts = [text[a:b] for a, b in zip(starts.tolist(), stops.tolist())]
    return codes_, d1, d2, weights, keys, pa.array(parts, pa.binary())


STRETCH = ["code", "d1", "d2"]


def _shard_starts(stretches: DataFrame) -> DataFrame:
    """(code, d1, d2, start) of repeated windows, by suffix arrays over shards.

    A shard holds all stretches of its codes; it is closed at the next code once it is large.
    Every window holds its stretch's key, and equal windows hold equal keys at one place. So
    a key stands as one symbol, which is that of no other bytes, and windows get shorter.
    """

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        symbols: dict[bytes, int] = {}
        parts = []
        for row in rows:
            key, part = row[4], row[5]
            symbol = 256 + symbols.setdefault(part[key : key + KEY_SIZE], len(symbols))
            sides = np.frombuffer(part[:key] + b"\0" + part[key + KEY_SIZE :], dtype=np.uint8)
            parts.append(sides.astype(np.int64))
            parts[-1][key] = symbol
        starts = repeated_starts(parts, np.array([r[3] for r in rows]), WINDOW - KEY_SIZE + 1)
        owner = np.repeat(np.arange(len(rows)), [len(s) for s in starts])
        columns = [pa.array([r[i] for r in rows], pa.int64()).take(pa.array(owner)) for i in range(3)]
        flat = np.concatenate([*starts, np.zeros(0, dtype=np.int64)]).astype(np.int64)
        return pa.RecordBatch.from_arrays([*columns, pa.array(flat)], names=[*STRETCH, "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= SHARD_BYTES and row[0] != shard[-1][0]:
                    yield solve(shard)
                    shard, size = [], 0
                shard.append(row)
                size += len(row[5])
        if shard:
            yield solve(shard)

    return (
        stretches.select(*STRETCH, "weight", "key", "bytes")
        .repartition("code")
        .sortWithinPartitions("code")
        .mapInArrow(run, "code long, d1 long, d2 long, at long")
    )


def _counted_starts(stretches: DataFrame) -> DataFrame:
    """The same for codes with more stretches than a shard may hold: windows by digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                part = row[4]
                n = len(part) - WINDOW + 1
                digests = b"".join(xxhash.xxh3_128_digest(part[i : i + WINDOW]) for i in range(n))
                keys = np.frombuffer(digests, dtype="<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(np.full(n, v, dtype=np.int64)) for v in row[:4]),
                        pa.array(np.arange(n)),
                        pa.array(keys[:, 0].copy()),
                        pa.array(keys[:, 1].copy()),
                    ],
                    names=[*STRETCH, "weight", "at", "k1", "k2"],
                )

    windows = stretches.select(*STRETCH, "weight", "bytes").mapInArrow(
        run, "code long, d1 long, d2 long, weight long, at long, k1 long, k2 long"
    )
    often = windows.groupBy("k1", "k2").agg(F.sum("weight").alias("_times")).filter("_times > 1")
    return windows.join(often, ["k1", "k2"]).select(*STRETCH, "at")


def _cut(text: bytes, starts: np.ndarray, stops: np.ndarray):
    """(bytes removed, runs removed, SHA-256 of the bytes kept)."""
    gone = covered(len(text), starts, stops)
    kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
    return [int(gone.sum())], [len(runs(gone)[0])], [hashlib.sha256(kept).hexdigest()]


def remove_strings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_bytes: int = KEY_BYTES
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every row.

    A byte goes if a string of 200 bytes over it starts anywhere else too, in another text or
    in the same; all places of such a string go. Strings are judged on the input and do not
    cross texts. Rows equal in id and text are one document; NULL and empty texts have no
    bytes; an empty input gives no rows; other columns are left out.

    A string is looked at through the least of its 32-byte strings, which equal ones choose
    alike; so only stretches whose anchor, and then 84 bytes more at one side of it, occur
    twice can hold a repeat. Equal stretches are one with a weight; a key whose
    stretches all occur twice needs no more. The different stretches of a key meet in one shard, whose suffix
    array and common prefixes show the repeats in it. Keys with more
    than ``key_bytes`` of different stretches are spread out and counted by digest instead.
    Texts equal as a whole are found first, and one of them is searched for the others.
    """
    rows = repeats.keyed(docs, id_col, text_col)
    powers = Powers()
    facts = repeats.described(rows, _described(powers), "strings-facts")
    single = repeats.one_per_key(facts)
    firsts = materialise(repeats.copies(single), "strings-copies")
    texts = repeats.one_per_key(repeats.candidates(rows, facts, firsts, "strings-texts"))

    schema = "code long, d1 long, d2 long, key long, start long, stop long"
    stretches = materialise(
        repeats.mapped(texts, _stretches(powers), ["_at"], schema), "strings-stretches"
    )
    # Equal stretches count together and are known by the first place of one of them.
    place = F.struct(*KEY, "start", "stop", "key")
    distinct = stretches.groupBy(*STRETCH).agg(
        F.count(F.lit(1)).alias("weight"), F.min(place).alias("_place")
    )
    per_code = distinct.groupBy("code").agg(
        F.sum("weight").alias("_times"),
        F.min("weight").alias("_least"),
        F.sum(F.col("_place.stop") - F.col("_place.start")).alias("_bytes"),
    )
    met = materialise(
        distinct.join(per_code.filter("_times > 1"), "code")
        .withColumn("_alike", F.col("_least") > 1)
        .select(
            *STRETCH, "weight", "_place.*", "_alike", "_bytes"
        ),
        "strings-distinct",
    )
    # Where every stretch of a key is met more than once, all of them are repeated.
    alike = met.filter("_alike").select(
        *STRETCH, F.array(F.struct(F.lit(0).cast("long").alias("at"), (F.col("stop") - F.col("start")).alias("upto"))).alias("_spans")
    )
    named = F.struct(*STRETCH, "weight", "key", "start", "stop")
    columns = ["code", "d1", "d2", "weight", "key", "start", "stop"]
    wanted = (
        met.filter("NOT _alike")
        .groupBy(*KEY, (F.col("_bytes") > key_bytes).alias("_large"))
        .agg(F.collect_list(named).alias("_named"))
        .select(*KEY, *(F.col(f"_named.{c}").alias(f"_{c}") for c in columns), "_large")
    )
    read = repeats.join_key(texts, materialise(wanted, "strings-wanted"))

    def stretches_of(large: bool) -> DataFrame:
        part = read.filter(F.col("_large") == F.lit(large))
        return repeats.mapped(
            part,
            _bytes,
            [f"_{c}" for c in columns],
            "code long, d1 long, d2 long, weight long, key long, bytes binary",
        )

    starts = _shard_starts(stretches_of(False)).unionByName(_counted_starts(stretches_of(True)))
    unlike = starts.groupBy(*STRETCH).agg(
        F.collect_list(F.struct("at", (F.col("at") + WINDOW).alias("upto"))).alias("_spans")
    )
    spans = materialise(unlike.unionByName(alike), "strings-spans")
    of_docs = (
        stretches.select(*KEY, *STRETCH, "start")
        .join(spans, STRETCH)
        .select(*KEY, "start", "_spans")
        .groupBy(*KEY)
        .agg(
            F.flatten(
                F.collect_list(
                    F.transform(
                        "_spans",
                        lambda x: F.struct(
                            (x["at"] + F.col("start")).alias("at"),
                            (x["upto"] + F.col("start")).alias("upto"),
                        ),
                    )
                )
            ).alias("_all")
        )
        .select(*KEY, F.col("_all.at").alias("_starts"), F.col("_all.upto").alias("_stops"))
    )
    cut = repeats.mapped(
        repeats.join_key(texts, materialise(of_docs, "strings-cuts")),
        _cut,
        ["_starts", "_stops"],
        "n_removed long, n_spans long, kept_sha256 string",
    )

    joined = repeats.join_key(
        facts.select(*KEY, "_n", "_sha").join(firsts.select("_sha", "_keys"), "_sha"), cut, "left"
    )
    whole = (F.col("_keys") > 1) & (F.col("_n") >= WINDOW)
    return joined.select(
        F.col("_id").alias(id_col),
        F.col("_n").alias("n_bytes"),
        F.when(whole, F.col("_n")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest()))
        .otherwise(F.coalesce("kept_sha256", "_sha"))
        .alias("kept_sha256"),
    )
