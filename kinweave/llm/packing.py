"""Packing token pieces into sequences by minimum bin slack over a histogram of lengths."""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.session import materialise

CAPACITY = 2048
END_ID = 0
# Distinct words and word parts a task remembers the ids of.
MEMORY_WORDS = 600_000
# Pieces that one task numbers at a time.
NUMBERED_ROWS = 20_000
# Printable ASCII and the Latin letters next to it, which lower-case one to one.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
# The tokenizer's own split, for such text in lower case.
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")


def _shown() -> dict[int, int]:
    """How byte-level merges write a byte: printable ones as they are, others from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: 256 + i for i, b in enumerate(others)}


SHOWN = _shown()


class _Memory(dict):
    """Results of a function, forgotten all at once when there are too many."""

    def __init__(self, work, most: int):
        super().__init__()
        self.work, self.most = work, most

    def __missing__(self, key: bytes) -> bytes:
        if len(self) >= self.most:
            self.clear()
        self[key] = found = self.work(key)
        return found


def word_encoder(tokenizer_json: str):
    """From a text's UTF-8 bytes to its ids as little-endian unsigned 32-bit numbers.

    The tokenizer parts texts at white space, so a text's ids are those of its words, and
    words repeat. Words of plain letters are split here and go to the merges at once; all
    others, and those that may hold a special token, go through the whole tokenizer.
    """
    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(tokenizer_json)
    merges = whole.model.tokenize

    def packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def of_part(part: str) -> bytes:
        shown = part if part.isascii() else part.encode().decode("latin-1").translate(SHOWN)
        return packed([token.id for token in merges(shown)])

    parts = _Memory(of_part, MEMORY_WORDS)

    def of_word(word: bytes) -> bytes:
        text = word.decode()
        if PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join(map(parts.__getitem__, PARTS.findall(text.lower())))
        return packed(whole.encode(text, add_special_tokens=False).ids)

    words = _Memory(of_word, MEMORY_WORDS)
    return lambda text: b"".join(map(words.__getitem__, text.split()))


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32): each document's ids and end mark, cut at capacity."""
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer_json = file.read()
    schema = T.StructType(
        [
            docs.schema[id_col],
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(tokenizer_json)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            owner, piece, start, length, crc = [], [], [], [], []
            for row, text in enumerate(batch.column(1).cast(pa.binary())):
                ids = encode(text.as_py() or b"") + end
                for at in range(0, len(ids), 4 * capacity):
                    part = ids[at : at + 4 * capacity]
                    owner.append(row)
                    piece.append(at // (4 * capacity))
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owner, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *(pa.array(v, pa.int64()) for v in (start, length, crc)),
                ],
                names=schema.names,
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The fullest combination that holds the longest length: length -> number.

    Bit s of ``sums`` says that some of the lengths looked at add up to s; a length enters by
    powers of two up to its count. Lengths are looked at from the longest; the search ends
    once the bin can be filled. Going back through the steps gives the numbers.
    """
    lengths = sorted((n for n, c in counts.items() if c), reverse=True)
    first = lengths[0]
    room = capacity - first
    full, sums, steps = (1 << (room + 1)) - 1, 1, []
    for length in lengths:
        left = min(counts[length] - (length == first), room // length)
        times = 1
        while left > 0:
            use = min(times, left)
            steps.append((length, use, sums))
            sums |= (sums << (length * use)) & full
            left, times = left - use, times * 2
        if sums >> room & 1:
            break
    used, at = {first: 1}, sums.bit_length() - 1
    for length, use, before in reversed(steps):
        if not before >> at & 1:
            at -= length * use
            used[length] = used.get(length, 0) + use
    return used


@dataclass
class Run:
    """``times`` bins from ``bin`` on hold ``number`` pieces of ``length`` each, at ``offset``."""

    length: int
    number: int
    offset: int
    bin: int
    times: int


def minimum_slack(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """All bins, bin by bin the fullest combination of what is left.

    What is left only shrinks, so a combination stays the fullest as long as its pieces
    last: equal bins are laid out in one step. There are at most ``capacity`` lengths, and
    each step uses one up or leaves less than the step took, so the number of steps does not
    grow with the number of pieces.
    """
    left, runs, bin_ = {n: c for n, c in counts.items() if c}, [], 0
    while left:
        used = fullest(left, capacity)
        times = min(left[n] // k for n, k in used.items())
        offset = 0
        for length, number in used.items():
            runs.append(Run(length, number, offset, bin_, times))
            offset += length * number
            left[length] -= number * times
            if not left[length]:
                del left[length]
        bin_ += times
    return runs


def _numbered(pieces: DataFrame) -> DataFrame:
    """Add ``_rank``, a number from 0 among the pieces of equal length.

    Pieces are dealt into equal parts; each is numbered by itself from an offset, so a
    length that a third of all pieces has is spread over all parts.
    """
    parts = max(1, math.ceil(pieces.count() / NUMBERED_ROWS))
    dealt = pieces.withColumn("_part", F.pmod(F.xxhash64("_row"), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("_part")
    base = (
        dealt.groupBy("length", "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_base", F.sum("_n").over(before) - F.col("_n"))
        .drop("_n")
    )
    inner = Window.partitionBy("length", "_part").orderBy("_row")
    return (
        dealt.withColumn("_nth", F.row_number().over(inner) - 1)
        .join(base, ["length", "_part"])
        .withColumn("_rank", F.col("_base") + F.col("_nth"))
        .drop("_part", "_nth", "_base", "_row")
    )


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset): every piece in its place.

    A document is its ids and an end mark; NULL and empty texts are the end mark alone. Only
    documents longer than a sequence are cut. Repeated rows and NULL ids are packed as rows
    of their own; an empty input gives no rows; other columns are left out.

    Only the histogram of lengths, at most ``capacity`` numbers, meets in one place; the
    layout computed from it tells each piece its place by length and rank.
    """
    pieces = materialise(
        token_pieces(docs, tokenizer_path, id_col, text_col, capacity).withColumn(
            "_row", F.monotonically_increasing_id()
        ),
        "pack-pieces",
    )
    counts = dict(pieces.groupBy("length").agg(F.count(F.lit(1))).collect())
    runs = sorted(minimum_slack(counts, capacity), key=lambda r: (r.length, r.bin))
    # Pieces in the order of (length, rank) have one number each; a run is a range of them.
    first, at = {}, 0
    for length in sorted(counts):
        first[length], at = at, at + counts[length]
    base = np.zeros(capacity + 1, dtype=np.int64)
    base[list(first)] = list(first.values())
    sizes = np.array([r.number * r.times for r in runs], dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    number, offset, bins = (
        np.array([getattr(r, name) for r in runs], dtype=np.int64)
        for name in ("number", "offset", "bin")
    )
    names = [id_col, "piece", "start", "length", "ids_crc32"]
    schema = T.StructType(
        [
            *(pieces.schema[n] for n in names),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(3).to_numpy()
            position = base[length] + batch.column(5).to_numpy()
            run = np.searchsorted(begin, position, side="right") - 1
            nth = position - begin[run]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:5],
                    pa.array(bins[run] + nth // number[run]),
                    pa.array(offset[run] + nth % number[run] * length),
                ],
                names=schema.names,
            )

    return _numbered(pieces).select(*names, "_rank").mapInArrow(place, schema)
