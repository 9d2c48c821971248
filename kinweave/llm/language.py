"""Language identification by a linear-chain conditional random field over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.session import materialise

UNKNOWN = "und"
# Bound of the training sample: documents of a language that are expected to be in it, each
# with its whole text. Nothing else is left out.
DOCS_PER_LANGUAGE = 600
# A training text is dealt out in pieces of about so many characters.
PIECE = 2000
# Shards that learn side by side, and how often their weights are brought together.
SHARDS, ROUNDS = 8, 3
# Sequences are stitched from stretches of pieces of any language; words of one update.
LENGTH, STRETCH, GROUP_WORDS = 32, 12, 1024
RATE, DECAY = 0.3, 1e-5
BUCKETS = 1 << 16
# Slots of the lexicon: every word has one.
LEXICON = 1 << 16
SEED = 7
# Words side by side in a block of the chain.
BLOCK = 64
CHUNK_BYTES = 1 << 18
MIX = np.uint32(2654435761)
WORD_BASE = np.uint64(0x9E3779B97F4A7C15)

# What a byte of lower-case text counts as: itself in a word, else a blank.
_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[128:] = True
_PLAIN = np.where(_LETTER, np.arange(256), 32).astype(np.uint8)


def _buffer(text: str) -> np.ndarray:
    """Lower-case bytes between blanks, all that is no letter blanked."""
    raw = np.frombuffer(f"  {text.lower()}   ".encode("utf-8", "replace"), dtype=np.uint8)
    return _PLAIN[raw]


def _bounds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    letter = buf != 32
    edge = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    return edge[::2], edge[1::2]


def _bucket(code: np.ndarray, kind: int) -> np.ndarray:
    return ((code ^ np.uint32(kind << 27)) * MIX) >> np.uint32(16)


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def _lexicon(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The slot of each word in the lexicon, behind the buckets."""
    base = int(WORD_BASE)
    powers = np.cumprod(np.full(len(buf), WORD_BASE, dtype=np.uint64))
    back = np.cumprod(np.full(len(buf), np.uint64(_inverse(base)), dtype=np.uint64))
    sums = np.cumsum(buf.astype(np.uint64) * powers)
    codes = (sums[ends - 1] - sums[starts - 1]) * back[starts]
    slots = (codes * WORD_BASE) >> np.uint64(64 - LEXICON.bit_length() + 1)
    return slots.astype(np.int64) + BUCKETS


def _grams(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Buckets of the n-grams around each letter, and where each word's begin."""
    at = np.flatnonzero(buf != 32)
    b = buf.astype(np.uint32)
    mid = b[at] << np.uint32(8)
    three = _bucket((b[at - 1] << np.uint32(16)) | mid | b[at + 1], 1)
    two = _bucket(mid | b[at + 1], 2)
    sizes = ends - starts
    return three, two, np.cumsum(sizes) - sizes


def _affixes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Buckets of prefixes and suffixes of one to three bytes, one per word each."""
    b = buf.astype(np.uint32)
    found = []
    for kind, (place, way) in enumerate(((starts, 1), (ends - 1, -1))):
        code = np.zeros(len(starts), dtype=np.uint32)
        for n in range(3):
            code = (code << np.uint32(8)) | b[place + way * n]
            found.append(_bucket(code, 3 + 3 * kind + n))
    return found


@dataclass
class Field:
    """The model: labels, weights of the buckets and of the lexicon's slots, transitions."""

    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray

    def emissions(self, buf: np.ndarray) -> np.ndarray:
        """Score of each label for each word of a buffer, in pieces of bounded size."""
        found, at = [], 0
        while at < len(buf):
            end = min(len(buf), at + CHUNK_BYTES)
            if end < len(buf):  # cut at the last blank; a longer word is cut where it is
                blanks = np.flatnonzero(buf[at + 1 : end] == 32)
                end = at + 2 + int(blanks[-1]) if len(blanks) else end
            part = np.concatenate(([32, 32], buf[at:end], [32, 32, 32])).astype(np.uint8)
            starts, ends = _bounds(part)
            if len(starts):
                three, two, first = _grams(part, starts, ends)
                rows = self.weights[three]
                rows += self.weights[two]
                score = np.add.reduceat(rows, first, axis=0)
                for bucket in _affixes(part, starts, ends):
                    score += self.weights[bucket]
                score += self.weights[_lexicon(part, starts, ends)]
                found.append(score)
            at = end
        return np.concatenate(found) if found else np.zeros((0, len(self.labels)), np.float32)


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def marginals(scores: np.ndarray, sizes: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Posterior of each label for each word, by forward-backward over each document.

    ``scores`` holds the words of documents of ``sizes`` (none zero) one after another. A
    document is cut into blocks of 64 words that are walked side by side: first each block's
    product of steps, then the messages from block to block, then the words inside.
    """
    n_labels = scores.shape[1]
    step = np.exp(transitions - transitions.max())
    like = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64)
    blocks = -(-sizes // BLOCK)
    first_block = np.cumsum(blocks) - blocks
    first_word = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(sizes)), sizes)
    nth = np.arange(len(doc)) - first_word[doc]
    row, col = first_block[doc] + nth // BLOCK, nth % BLOCK
    n_rows = int(blocks.sum())
    grid = np.ones((BLOCK, n_rows, n_labels))
    grid[col, row] = like
    used = np.zeros((BLOCK, n_rows), dtype=bool)
    used[col, row] = True

    product = np.tile(np.eye(n_labels), (n_rows, 1, 1))
    for t in range(BLOCK):
        moved = (product.reshape(-1, n_labels) @ step).reshape(product.shape)
        moved *= grid[t][:, None, :]
        moved /= moved.sum(axis=(1, 2), keepdims=True)
        product = np.where(used[t][:, None, None], moved, product)

    into = np.full((n_rows, n_labels), 1.0 / n_labels)
    out = np.full((n_rows, n_labels), 1.0)
    by_size = np.argsort(-blocks, kind="stable")
    ordered = blocks[by_size]
    for k in range(1, int(ordered[0])):
        docs = by_size[: np.searchsorted(-ordered, -k, side="left")]
        here = first_block[docs] + k
        into[here] = _scaled(np.einsum("ri,rij->rj", into[here - 1], product[here - 1]))
    for k in range(int(ordered[0]) - 1, 0, -1):
        docs = by_size[: np.searchsorted(-ordered, -k, side="left")]
        here = first_block[docs] + k
        out[here - 1] = _scaled(np.einsum("rij,rj->ri", product[here], out[here]))

    ahead = np.empty_like(grid)
    alpha = into
    for t in range(BLOCK):
        alpha = _scaled((alpha @ step) * grid[t])
        ahead[t] = alpha
    beta = out
    for t in range(BLOCK - 1, -1, -1):
        ahead[t] *= beta
        beta = np.where(used[t][:, None], _scaled((grid[t] * beta) @ step.T), beta)
    return _scaled(ahead[col, row])


class Learner:
    """Learns the field from groups of stitched sequences, by adaptive gradient steps.

    All words of a piece have its document's label; a label's words weigh by how rare they
    are in the sample. Sequences stitched from stretches of several languages teach the
    transitions what a change of language looks like.
    """

    def __init__(self, weights: np.ndarray, transitions: np.ndarray, share: np.ndarray) -> None:
        self.weights, self.transitions, self.share = weights, transitions, share
        self.squares = np.full(weights.shape, 1e-3, np.float32)
        self.t_squares = np.full(transitions.shape, 1e-3)

    def learn(self, pieces: Iterator[tuple[int, str]], rng: np.random.Generator) -> None:
        """Update with all words of (label, piece), in groups of mixed stretches."""
        stretches, size = [], 0
        for label, text in pieces:
            buf = _buffer(text)
            starts, ends = _bounds(buf)
            at = 0
            while at < len(starts):
                n = min(int(rng.integers(1, STRETCH + 1)), len(starts) - at)
                stretches.append((label, n, buf[starts[at] : ends[at + n - 1] + 1]))
                at += n
                size += n
            # The pool is twice a group, so that long pieces mix with what follows.
            while size >= 2 * GROUP_WORDS:
                stretches, size = self._group(stretches, GROUP_WORDS, rng)
        while size:
            stretches, size = self._group(stretches, min(GROUP_WORDS, size), rng)

    def _group(self, stretches: list, least: int, rng: np.random.Generator) -> tuple[list, int]:
        """Update with random stretches of at least so many words; the rest is returned."""
        order = rng.permutation(len(stretches))
        sizes = np.cumsum([stretches[i][1] for i in order])
        cut = int(np.searchsorted(sizes, least)) + 1
        taken = [stretches[i] for i in order[:cut]]
        blank = np.array([32, 32, 32], np.uint8)
        buf = np.concatenate([blank, *(part for _, _, part in taken), blank])
        truth = np.repeat([label for label, _, _ in taken], [n for _, n, _ in taken])
        whole = len(truth) // LENGTH * LENGTH
        starts, ends = _bounds(buf)
        if whole:
            self._update(buf, starts[:whole], ends[:whole], truth[:whole].reshape(-1, LENGTH))
        if whole < len(truth):
            self._update(buf, starts[whole:], ends[whole:], truth[None, whole:])
        left = [stretches[i] for i in order[cut:]]
        return left, sum(n for _, n, _ in left)

    def _update(
        self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, truth: np.ndarray
    ) -> None:
        """One step by the gradient over sequences of one length."""
        n_seq, length = truth.shape
        n_labels, n_words = len(self.share), truth.size
        part = np.concatenate([[32, 32], buf[starts[0] : ends[-1]], [32, 32]]).astype(np.uint8)
        starts, ends = starts - (starts[0] - 2), ends - (starts[0] - 2)
        three, two, _ = _grams(part, starts, ends)
        of_gram = np.repeat(np.arange(n_words, dtype=np.int32), ends - starts)
        single = [*_affixes(part, starts, ends), _lexicon(part, starts, ends)]
        ids = np.concatenate([three, two, *single]).astype(np.int32)
        each = np.arange(n_words, dtype=np.int32)
        words = np.concatenate([of_gram, of_gram, *[each] * len(single)])
        by_word = np.argsort(words, kind="stable")
        firsts = np.searchsorted(words[by_word], each)
        scores = np.add.reduceat(self.weights[ids[by_word]], firsts, axis=0).astype(np.float64)

        like = np.exp(scores - scores.max(axis=1, keepdims=True)).reshape(n_seq, length, n_labels)
        step = np.exp(self.transitions - self.transitions.max())
        alphas, betas = np.empty_like(like), np.ones_like(like)
        alpha = np.full((n_seq, n_labels), 1.0 / n_labels)
        for t in range(length):
            alphas[:, t] = alpha = _scaled((alpha @ step) * like[:, t])
        expected = np.zeros_like(step)
        for t in range(length - 2, -1, -1):
            onward = like[:, t + 1] * betas[:, t + 1]
            # The pairs of a place sum to one: divide by their total before they are summed.
            total = np.einsum("si,ij,sj->s", alphas[:, t], step, onward)
            expected += step * ((alphas[:, t] / total[:, None]).T @ onward)
            betas[:, t] = _scaled(onward @ step.T)
        truth = truth.ravel()
        gap = -_scaled(alphas * betas).reshape(n_words, n_labels)
        gap[each, truth] += 1.0
        gap = (gap * (self.share[truth] / n_words)[:, None]).astype(np.float32)

        by_id = np.argsort(ids, kind="stable")
        rows, at = np.unique(ids[by_id], return_index=True)
        grad = np.add.reduceat(gap[words[by_id]], at, axis=0) - DECAY * self.weights[rows]
        self.squares[rows] += grad**2
        self.weights[rows] += RATE * grad / np.sqrt(self.squares[rows])
        seen = np.zeros_like(step)
        chain = truth.reshape(n_seq, length)
        np.add.at(seen, (chain[:, :-1].ravel(), chain[:, 1:].ravel()), 1.0)
        t_grad = (seen - expected) / n_words
        self.t_squares += t_grad**2
        self.transitions += RATE * t_grad / np.sqrt(self.t_squares)


def sample(
    docs: DataFrame, learn: Column, id_col: str, text_col: str, label_col: str
) -> tuple[DataFrame, list[str], np.ndarray]:
    """(_shard, _label, _piece) of the bounded training sample, its labels, and their shares.

    A row is in the sample if a hash of its id and text is low enough for about 600 rows of
    its language, so no group of a language is gathered or sorted to choose them. Rows that
    repeat id and text count once. The whole text of each is cut into pieces, which a hash
    deals to shards in a random order that does not depend on the partitioning. Only numbers
    per language reach the driver.
    """
    h = F.xxhash64(id_col, text_col)
    known = docs.filter(
        learn & F.col(label_col).isNotNull() & F.col(text_col).isNotNull()
    ).select(F.col(label_col).alias("_label"), h.alias("_h"), F.col(text_col).alias("_text"))
    counts = dict(known.groupBy("_label").agg(F.count(F.lit(1))).collect())
    if not counts:
        return known, [], np.zeros(0)
    place = F.lit(None).cast("double")
    for label, n in sorted(counts.items()):
        most = min(1.0, DOCS_PER_LANGUAGE / n)
        place = F.when(F.col("_label") == label, F.lit(most)).otherwise(place)
    low = F.shiftrightunsigned("_h", 11) / F.lit(float(1 << 53)) < place
    cut = r"(?s).{1,%d}(?:\s|$)|.{1,%d}" % (PIECE, PIECE)
    pieces = (
        known.filter(low)
        .dropDuplicates(["_label", "_h"])
        .select("_label", "_h", F.posexplode(F.regexp_extract_all("_text", F.lit(cut), F.lit(0))))
        .withColumn("_order", F.xxhash64("_h", "pos"))
        .withColumn("_shard", F.pmod("_order", F.lit(SHARDS)).cast("int"))
    )
    pieces = materialise(
        pieces.repartitionByRange(SHARDS, "_shard")
        .sortWithinPartitions("_shard", "_order", "_label", "col")
        .select("_shard", "_label", F.col("col").alias("_piece")),
        "language-sample",
    )
    # Letters tell how much of a label there is to learn from; a label without any is none.
    letters = F.sum(F.length(F.regexp_replace("_piece", r"[\x00-\x60\x7B-\x7F]", "")))
    size = {r[0]: r[1] for r in pieces.groupBy("_label").agg(letters).collect() if r[1]}
    labels = sorted(size)
    amount = np.array([size[label] for label in labels], dtype=float)
    return pieces, labels, amount.sum() / (len(labels) * amount) if labels else amount


def train(pieces: DataFrame, labels: list[str], share: np.ndarray) -> Field | None:
    """Fit the field to the sample; None without any labelled word.

    Each shard learns from its pieces in one task, beginning with the weights that all have
    learned together. A round's change of a weight is the mean over the shards that changed
    it. The driver holds two sets of weights, 512 KB a label each, and one shard's changes.
    """
    if not labels:
        return None
    n_labels = len(labels)
    spark = pieces.sparkSession
    weights = np.zeros((BUCKETS + LEXICON, n_labels), np.float32)
    transitions = np.zeros((n_labels, n_labels))
    number = {label: k for k, label in enumerate(labels)}
    schema = "_shard int, _rows binary, _change binary, _steps binary"
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast((weights, transitions))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = (
                (shard, number[label], piece)
                for batch in batches
                for shard, label, piece in zip(*(c.to_pylist() for c in batch.columns))
                if label in number
            )
            for shard, group in groupby(rows, key=itemgetter(0)):
                begin, moves = shared.value
                learner = Learner(begin.copy(), moves.copy(), share)
                rng = np.random.default_rng([SEED, turn, shard])
                learner.learn(((label, piece) for _, label, piece in group), rng)
                changed = np.flatnonzero((learner.weights != begin).any(axis=1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard], pa.int32()),
                        pa.array([changed.tobytes()], pa.binary()),
                        pa.array([(learner.weights[changed] - begin[changed]).tobytes()], pa.binary()),
                        pa.array([(learner.transitions - moves).tobytes()], pa.binary()),
                    ],
                    names=["_shard", "_rows", "_change", "_steps"],
                )

        # A row for each shard, read one at a time in the order of the shards. Stored first, as
        # the sort looks at its input twice.
        found = materialise(pieces.mapInArrow(run, schema), "language-round")
        change, times = np.zeros_like(weights), np.zeros(len(weights), np.float32)
        steps, shards = np.zeros_like(transitions), 0
        for row in found.orderBy("_shard").toLocalIterator():
            rows = np.frombuffer(row["_rows"], np.int32)
            change[rows] += np.frombuffer(row["_change"], np.float32).reshape(-1, n_labels)
            times[rows] += 1
            steps += np.frombuffer(row["_steps"]).reshape(n_labels, n_labels)
            shards += 1
        weights += change / np.maximum(times, 1)[:, None]
        transitions += steps / max(shards, 1)
        shared.destroy()
    return Field(labels, weights, transitions)


def predict(texts: list[str | None], field: Field | None) -> tuple[list[str], list[float]]:
    """Label and score of each text: the label of most words by their marginals."""
    labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    rows, found, sizes = [], [], []
    for i, text in enumerate(texts):
        if field is None or not text:
            continue
        words = field.emissions(_buffer(text))
        # Blanked bytes hide no a-z, so only texts of other letters need a closer look.
        if len(words) and any(map(str.isalpha, text)):
            rows.append(i)
            found.append(words)
            sizes.append(len(words))
    if rows:
        sizes = np.array(sizes)
        post = marginals(np.concatenate(found), sizes, field.transitions)
        shares = np.add.reduceat(post, np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
        for i, best, share in zip(rows, shares.argmax(axis=1), shares.max(axis=1)):
            labels[i], scores[i] = field.labels[best], min(1.0, float(share))
    return labels, scores


def label_languages(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    batch_bytes: int = 1 << 19,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row, with the columns of ``keep`` or all.

    The model learns from the whole texts of a sample of the rows where ``learn`` holds and the
    label is not NULL, about 600 of each label, and reads nothing but the text of a row to
    label it. It is sent to every task: 512 KB for each label. Every word of the whole
    text is labelled; the text has the label with most of it. A text that is NULL or has no
    letter is ``und`` with score 0, and so is every text if there was nothing to learn from.
    Repeated rows are labelled alike; columns of the two names in the input are replaced; an
    empty input gives no rows.
    """
    docs = docs.drop("lang_pred", "score")
    field = train(*sample(docs, learn, id_col, text_col, label_col))
    shared = docs.sparkSession.sparkContext.broadcast(field)
    keep = docs.columns if keep is None else keep
    schema = T.StructType(
        [
            *(docs.schema[name] for name in keep),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    # The text travels once, whether it is kept or not.
    names = keep if text_col in keep else [*keep, text_col]
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes, dtype=np.int64)
            labels, scores, begin = [], [], 0
            while begin < len(column):
                # As many texts as fit, and one at least.
                before = ends[begin] - sizes[begin]
                end = max(begin + 1, int(np.searchsorted(ends, before + batch_bytes, "right")))
                more = predict(column.slice(begin, end - begin).to_pylist(), shared.value)
                labels += more[0]
                scores += more[1]
                begin = end
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                names=schema.names,
            )

    return docs.select(*names).mapInArrow(run, schema)
