"""SimHash near-duplicates by an inverted index of fingerprint bytes with count filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.llm.components import components
from kinweave.session import materialise

SHINGLE = 3
SEED = 42
BYTES = 8
# Fingerprints link at this many differing bits or fewer, so all but two bytes agree.
MOST_BITS = 2
LEAST_BYTES = BYTES - MOST_BITS
# Two wrong bytes spoil two of four byte pairs at most: some two pairs are whole.
BYTE_PAIRS = tuple((2 * i, 2 * i + 1) for i in range(BYTES // 2))
LISTS = tuple(a + b for a, b in combinations(BYTE_PAIRS, 2))
# A list with more fingerprints is cut by two more byte positions.
LONG_LIST = 2048
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64 majority bits of the XXH64 of a text's word shingles; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    plain = b" ".join(words)
    blanks = np.flatnonzero(np.frombuffer(plain, dtype=np.uint8) == 32)
    starts = np.concatenate(([0], blanks + 1))
    ends = np.append(blanks, len(plain))
    if len(words) < shingle:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    hash_of, counts = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        part = slice(at, at + SHINGLES_AT_ONCE)
        hashes = np.array(
            [hash_of(plain[s:e], seed) for s, e in zip(starts[part].tolist(), ends[part].tolist())],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * counts > len(starts), bitorder="little")
    return int(majority.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, _fp) of every row; NULL counts as a text without words."""
    schema = T.StructType([docs.schema[id_col], T.StructField("_fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = [fingerprint(text.as_py() or b"") for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], names=schema.names
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _with_fingerprints(rows: DataFrame) -> DataFrame:
    """(_id, _text, _row, _fp) of every row of (_id, _text, _row)."""
    schema = T.StructType([*rows.schema.fields, T.StructField("_fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = [fingerprint(text.as_py() or b"") for text in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.int64())], names=schema.names
            )

    return rows.mapInArrow(run, schema)


def _mask(positions: tuple[int, ...]) -> int:
    """The bits of the named bytes, as a signed 64-bit number."""
    mask = sum(0xFF << (8 * p) for p in positions)
    return mask - (1 << 64) if mask >> 63 else mask


def _entries(fps: DataFrame, subsets: list[tuple[int, ...]] | None = None) -> DataFrame:
    """The index: each fingerprint in the list of its bytes at each of the position sets."""
    masks = F.array(*(F.lit(_mask(s)).cast("long") for s in subsets or LISTS))
    return fps.withColumn("mask", F.explode(masks)).withColumn(
        "key", F.col("_fp").bitwiseAND(F.col("mask"))
    )


def _longer(mask: Column) -> Column:
    """The position sets that add two positions to a list's four."""
    found = F.array().cast("array<long>")
    for positions in LISTS:
        rest = [p for p in range(BYTES) if p not in positions]
        wider = [_mask((*positions, *two)) for two in combinations(rest, LEAST_BYTES - len(positions))]
        found = F.when(
            mask == _mask(positions), F.array(*(F.lit(m).cast("long") for m in wider))
        ).otherwise(found)
    return found


def _pairs(fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of a list within the distance: tally equal bytes, filter, verify the bits."""
    split = fps.view(np.uint8).reshape(-1, BYTES)
    for at in range(0, len(fps), 256):
        tally = (split[at : at + 256, None, :] == split[None, :, :]).sum(axis=2, dtype=np.uint8)
        i, j = np.nonzero(tally >= LEAST_BYTES)
        i = i + at
        ahead = i < j
        i, j = i[ahead], j[ahead]
        near = np.bitwise_count(fps[i] ^ fps[j]) <= MOST_BITS
        yield i[near], j[near]


def _stars(fps: np.ndarray, mask: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same for a list of six agreeing bytes, where the tally is met by all pairs.

    The other two bytes have 65,536 values, so a list cannot be longer. Two values within two
    bits are both within one bit of some value; all that are within one bit of it link.
    """
    free = [b for b in range(64) if not mask >> b & 1]
    rest = np.zeros(len(fps), dtype=np.int64)
    for place, bit in enumerate(free):
        rest |= ((fps >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << place
    first = np.full(1 << len(free), -1, dtype=np.int64)
    flips = [0, *(1 << i for i in range(len(free)))]
    for flip in flips:
        middle = rest ^ flip
        new = first[middle] < 0
        first[middle[new]] = np.flatnonzero(new)
    for flip in flips:
        star = first[rest ^ flip]
        other = np.flatnonzero(star != np.arange(len(fps)))
        yield star[other], other


def _forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """Links that join the same rows as all the pairs: at most n - 1."""
    parent, links = list(range(n)), []
    for left, right in pairs:
        for i, j in zip(left.tolist(), right.tolist()):
            while parent[i] != i:
                parent[i] = i = parent[parent[i]]
            while parent[j] != j:
                parent[j] = j = parent[parent[j]]
            if i != j:
                parent[max(i, j)] = min(i, j)
                links.append((i, j))
    return links


def _linked(lists: DataFrame) -> DataFrame:
    """(a, b): links within each list of (mask, key, _fp)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in _with_end(batches):
            if batch is None:
                block, ends = kept, True
            else:
                now = np.stack([batch.column(c).to_numpy() for c in range(3)])
                block, ends = now if kept is None else np.concatenate([kept, now], axis=1), False
            if block is None or not block.shape[1]:
                continue
            mask, key, fp = block
            cut = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            starts = [0, *cut.tolist()]
            stops = [*cut.tolist(), block.shape[1]]
            if not ends:  # the last list may go on in the next batch
                kept = block[:, starts.pop() :]
                stops.pop()
            left, right = [], []
            for s, e in zip(starts, stops):
                if e - s > 1:
                    fps = fp[s:e].view(np.uint64)
                    pairs = _pairs(fps) if e - s <= LONG_LIST else _stars(fps, int(mask[s]))
                    for i, j in _forest(e - s, pairs):
                        left.append(fp[s + i])
                        right.append(fp[s + j])
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"]
            )

    return (
        lists.select("mask", "key", "_fp")
        .repartition("mask", "key")
        .sortWithinPartitions("mask", "key", "_fp")
        .mapInArrow(run, "a long, b long")
    )


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def fingerprint_links(fps: DataFrame, long_list: int = LONG_LIST) -> DataFrame:
    """(a, b): links between distinct fingerprints that join all within the distance.

    Single bytes would give 2,048 lists in all, each with a share of all fingerprints, so an
    entry of the index names four byte positions at once; six such sets are enough for every
    pair. Lists with one entry are left out before anything is paired. A list over the limit
    is replaced by lists of six positions, which cannot pass 65,536 entries.
    """
    entries = _entries(fps.select("_fp"))
    sizes = entries.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    met = materialise(entries.join(sizes, ["mask", "key"]), "simhash-lists")
    wider = (
        met.filter(F.col("_n") > long_list)
        .withColumn("mask", F.explode(_longer(F.col("mask"))))
        .withColumn("key", F.col("_fp").bitwiseAND(F.col("mask")))
        .select("mask", "key", "_fp")
        .distinct()
    )
    return _linked(
        met.filter(F.col("_n") <= long_list).select("mask", "key", "_fp").unionByName(wider)
    )


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", long_list: int = LONG_LIST
) -> DataFrame:
    """(id, fingerprint, component_id) of every row.

    A-Z are lower-cased; the bits of a fingerprint are the majority among the hashes of all
    three-word shingles. A text of fewer words is one shingle; a text without words, empty or
    NULL, has fingerprint zero and is linked like any other. Rows belong together if a chain
    of fingerprints with at most two differing bits joins them; the component is named by its
    smallest id (NULL if all its ids are NULL). Repeated rows are rows of their own; an empty
    input gives no rows; other columns are left out. Equal fingerprints meet in an aggregate
    and are linked once, however many rows share them.
    """
    rows = materialise(fingerprints(docs, id_col, text_col), "simhash-rows")
    return rows.join(_classes(rows, id_col, long_list).drop("_root"), "_fp").select(
        id_col,
        F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def _classes(rows: DataFrame, id_col: str, long_list: int = LONG_LIST) -> DataFrame:
    """(_root, _fp, component_id) of every fingerprint of (id, _fp); a component has one root."""
    distinct = rows.groupBy("_fp").agg(F.min(id_col).alias("_first"))
    roots = components(fingerprint_links(distinct, long_list))
    rooted = distinct.join(roots, F.col("_fp") == F.col("node"), "left").select(
        "_fp", "_first", F.coalesce("root", "_fp").alias("_root")
    )
    named = rooted.groupBy("_root").agg(F.min("_first").alias("component_id"))
    return rooted.select("_fp", "_root").join(named, "_root")


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, the one with its smallest id, with all columns.

    Rows without an id name no document to choose and stay. Rows with the same id and other
    texts are documents of their own: of those in one component the first by text stays, and
    those in other components are chosen there. An id of one row only is found by the id.
    """
    known = docs.filter(F.col(id_col).isNotNull())
    rows = materialise(fingerprints(known, id_col, text_col), "simhash-rows")
    classes = _classes(rows, id_col)
    first = (
        rows.join(classes, "_fp")
        .filter(F.col(id_col) == F.col("component_id"))
        .select(id_col, "_fp", "_root")
        .distinct()
    )
    repeated = rows.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(id_col)
    if repeated.isEmpty():
        chosen = known.join(first.select(id_col), id_col, "left_semi").select(*docs.columns)
    else:
        first, repeated = materialise(first, "simhash-first"), materialise(repeated, "simhash-repeated")
        alone = first.join(repeated, id_col, "left_anti").select(id_col)
        shared = known.join(first.join(repeated, id_col, "left_semi").select(id_col).distinct(), id_col, "left_semi")
        # The input's columns travel in one, so that none can be taken for a column made here.
        packed = shared.select(
            F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.struct(*docs.columns).alias("_row")
        )
        found = _with_fingerprints(packed).join(
            first.select(F.col(id_col).alias("_id"), "_fp", "_root"), ["_id", "_fp"]
        )
        # The text first, then all other columns, so that the choice does not vary.
        best = F.min(F.struct("_text", F.to_json("_row").alias("_json"), "_row")).alias("_best")
        chosen = (
            found.groupBy("_root")
            .agg(best)
            .select("_best._row.*")
            .unionByName(known.join(alone, id_col, "left_semi"))
        )
    return chosen.unionByName(docs.filter(F.col(id_col).isNull())).select(*docs.columns)
