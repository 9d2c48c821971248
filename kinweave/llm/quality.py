"""Quality classifier: a byte-level convolutional network over whole documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A document is cut into chunks of so many bytes, each beginning so many after the last.
CHUNK, HOP = 256, 192
EMBED, STRIDE, FILTERS, HIDDEN = 8, 4, 40, 24
# Bounds of the training sample: documents of each label, and bytes of all their texts. Texts
# are taken whole, in the order of a hash, as long as those before them are not too many bytes.
TRAIN_PER_LABEL = 1500
TRAIN_BYTES = 24 << 20
STEPS, BATCH, RATE = 400, 48, 4e-3
# Share of the training documents that a step cuts to one short stretch.
CROPPED = 0.25
SEED = 11
CHUNKS_AT_ONCE = 1024
THRESHOLD = 0.7
PAD = 0


@dataclass
class Net:
    """Weights. A filter sees two strides of bytes; ``low`` and ``high`` are its halves."""

    embed: np.ndarray
    low: np.ndarray
    high: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray


def chunked(text: bytes) -> np.ndarray:
    """All chunks of a text; they overlap and cover it whole. An empty text is one blank chunk."""
    n = max(1, -(-(len(text) - (CHUNK - HOP)) // HOP))
    flat = np.full((n - 1) * HOP + CHUNK, PAD, dtype=np.uint8)
    flat[: len(text)] = np.frombuffer(text, dtype=np.uint8)
    return np.lib.stride_tricks.sliding_window_view(flat, CHUNK)[::HOP]


def _convolved(net: Net, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inputs by stride and filter responses at every place of every chunk."""
    n, places = len(chunks), CHUNK // STRIDE
    x = net.embed[chunks].reshape(n * places, STRIDE * EMBED)
    low = (x @ net.low).reshape(n, places, FILTERS)
    high = (x @ net.high).reshape(n, places, FILTERS)
    return x.reshape(n, places, -1), low[:, :-1] + high[:, 1:]


def pooled(net: Net, chunks: np.ndarray) -> np.ndarray:
    """The greatest response of each filter in each chunk, and how full the chunk is."""
    parts = [
        _convolved(net, chunks[i : i + CHUNKS_AT_ONCE])[1].max(axis=1)
        for i in range(0, len(chunks), CHUNKS_AT_ONCE)
    ]
    return np.column_stack([np.maximum(np.concatenate(parts) + net.bias, 0), _filled(chunks)])


def _filled(chunks: np.ndarray) -> np.ndarray:
    return (chunks != PAD).mean(axis=1, dtype=np.float32)


def _combined(peaks: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Mean, greatest and least over a document's chunks."""
    return np.concatenate(
        [
            np.add.reduceat(peaks, first, axis=0) / sizes[:, None],
            np.maximum.reduceat(peaks, first, axis=0),
            np.minimum.reduceat(peaks, first, axis=0),
        ],
        axis=1,
    )


def _logits(net: Net, combined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.maximum(combined @ net.dense + net.dense_bias, 0)
    return hidden, hidden @ net.out + net.out_bias


def score_texts(net: Net, texts: list[bytes]) -> np.ndarray:
    """Probability of label 1 of each whole text, in groups of bounded size."""
    found, group, size = [], [], 0
    for i, text in enumerate(texts):
        group.append(chunked(text))
        size += len(group[-1])
        if size >= CHUNKS_AT_ONCE or i == len(texts) - 1:
            sizes = np.array([len(c) for c in group])
            peaks = pooled(net, np.concatenate(group))
            logit = _logits(net, _combined(peaks, np.cumsum(sizes) - sizes, sizes))[1]
            found.append(1 / (1 + np.exp(-np.clip(logit, -50, 50).astype(np.float64))))
            group, size = [], 0
    return np.concatenate(found) if found else np.zeros(0)


def train(docs: list[np.ndarray], labels: np.ndarray, share: float, seed: int = SEED) -> Net:
    """Fit the network by Adam on (chunks, label); both labels are drawn equally often.

    ``share`` of label 1 among all rows corrects the bias for that at the end. With one label
    only, the network answers with it alone.
    """
    rng = np.random.default_rng(seed)

    def init(*shape: int) -> np.ndarray:
        return (rng.normal(size=shape) * np.sqrt(2 / shape[0])).astype(np.float32)

    net = Net(
        rng.normal(size=(256, EMBED)).astype(np.float32) * 0.5,
        init(STRIDE * EMBED, FILTERS),
        init(STRIDE * EMBED, FILTERS),
        np.zeros(FILTERS, np.float32),
        init(3 * (FILTERS + 1), HIDDEN),
        np.zeros(HIDDEN, np.float32),
        init(HIDDEN),
        np.zeros(1, np.float32),
    )
    by_label = [np.flatnonzero(labels == k) for k in (0, 1)]
    if not all(map(len, by_label)):
        net.out[:] = 0
        net.out_bias[:] = 0 if not len(labels) else 6 * (2 * labels[0] - 1)
        return net
    names = list(vars(net))
    moment = {k: np.zeros_like(getattr(net, k)) for k in names}
    square = {k: np.zeros_like(getattr(net, k)) for k in names}
    for step in range(1, STEPS + 1):
        pick = np.concatenate([rng.choice(rows, BATCH // 2) for rows in by_label])
        batch = [_cropped(docs[i], rng) if rng.random() < CROPPED else docs[i] for i in pick]
        sizes = np.array(list(map(len, batch)))
        chunks = np.concatenate(batch)
        first = np.cumsum(sizes) - sizes
        grad = _gradient(net, chunks, first, sizes, labels[pick])
        for k in names:
            moment[k] = 0.9 * moment[k] + 0.1 * grad[k]
            square[k] = 0.99 * square[k] + 0.01 * grad[k] ** 2
            rate = RATE * min(1.0, 2 * (1 - step / STEPS))
            fair = np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8
            setattr(net, k, getattr(net, k) - rate * moment[k] / (1 - 0.9**step) / fair)
    for k in names:
        setattr(net, k, getattr(net, k).astype(np.float32))
    net.out_bias += np.float32(np.log(share / (1 - share)))
    return net


def _cropped(chunks: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A short stretch of one chunk, as short texts are rarer than they should be."""
    chunk = chunks[rng.integers(len(chunks))]
    n = min(int((chunk != PAD).sum()), int(rng.integers(12, 160)))
    at = int(rng.integers(int((chunk != PAD).sum()) - n + 1))
    return chunked(chunk[at : at + n].tobytes())


def _blocks(n: int) -> Iterator[slice]:
    return (slice(i, min(n, i + CHUNKS_AT_ONCE)) for i in range(0, n, CHUNKS_AT_ONCE))


def _gradient(
    net: Net, chunks: np.ndarray, first: np.ndarray, sizes: np.ndarray, labels: np.ndarray
) -> dict[str, np.ndarray]:
    """Gradients of the mean cross-entropy; pooling passes them to the places it chose.

    Chunks are convolved in blocks; of each only the chosen places and their responses are kept.
    """
    n = len(chunks)
    place = np.empty((n, FILTERS), np.int64)
    peak = np.empty((n, FILTERS), net.low.dtype)
    for block in _blocks(n):
        response = _convolved(net, chunks[block])[1]
        place[block] = response.argmax(axis=1)
        peak[block] = np.take_along_axis(response, place[block][:, None, :], axis=1)[:, 0]
    peak += net.bias
    peaks = np.column_stack([np.maximum(peak, 0), _filled(chunks)])
    combined = _combined(peaks, first, sizes)
    hidden, logit = _logits(net, combined)
    slope = (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - labels) / len(labels)
    grad = {"out": hidden.T @ slope, "out_bias": slope.sum(keepdims=True)}
    back = np.outer(slope, net.out) * (hidden > 0)
    grad |= {"dense": combined.T @ back, "dense_bias": back.sum(axis=0)}
    back = back @ net.dense.T
    # The last column of each third is the filling, which has no weights of its own.
    mean, most, least = (part[:, :FILTERS] for part in np.split(back, 3, axis=1))
    _, top, bottom = (part[:, :FILTERS] for part in np.split(combined, 3, axis=1))
    peaks = peaks[:, :FILTERS]
    doc = np.repeat(np.arange(len(sizes)), sizes)
    d_peak = (mean / sizes[:, None])[doc]
    for part, extreme in ((most, top), (least, bottom)):
        hit = peaks == extreme[doc]
        d_peak += part[doc] * hit / np.add.reduceat(hit, first, axis=0)[doc]
    d_peak *= peak > 0
    grad["bias"] = d_peak.sum(axis=0)
    grad["embed"] = np.zeros_like(net.embed)
    for name, shift in (("low", 0), ("high", 1)):
        weights = getattr(net, name)
        grad[name] = np.zeros_like(weights)
        for block in _blocks(n):
            rows = np.arange(block.stop - block.start)[:, None]
            bytes_ = chunks[block].reshape(len(rows), -1, STRIDE)[rows, place[block] + shift]
            seen = net.embed[bytes_].reshape(len(rows), FILTERS, STRIDE * EMBED)
            grad[name] += np.einsum("nfd,nf->df", seen, d_peak[block])
            d_x = (d_peak[block][:, :, None] * weights.T[None]).reshape(-1, EMBED)
            for e in range(EMBED):
                grad["embed"][:, e] += np.bincount(bytes_.ravel(), d_x[:, e], minlength=256)
    return grad


def sample(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str, text_col: str, label_col: str
) -> tuple[list[np.ndarray], np.ndarray, float]:
    """The bounded training sample, and the share of label 1 among all labelled rows.

    At most 1,500 documents of each label in the order of a hash of the id. Of their rows (an id
    may repeat) at most 6,000 in the order of a hash of id and text, as long as those before
    them hold less than 24 MB; each with all chunks of its whole text.
    """
    known = labels.filter(learn & F.col(label_col).isin(0, 1)).select(
        id_col, F.col(label_col).cast("int").alias("_label")
    )
    counts = dict(known.groupBy("_label").agg(F.count(F.lit(1))).collect())
    picked = None
    for label in (0, 1):
        some = known.filter(F.col("_label") == label).orderBy(F.xxhash64(id_col), id_col)
        some = some.limit(TRAIN_PER_LABEL)
        picked = some if picked is None else picked.unionByName(some)
    raw = F.encode(F.coalesce(text_col, F.lit("")), "UTF-8")
    rows = docs.select(id_col, raw.alias("_raw")).join(F.broadcast(picked), id_col)  # at most 3,000 ids
    order = ["_h", id_col, "_label"]
    keyed = rows.withColumn("_h", F.xxhash64(id_col, "_raw"))
    sized = keyed.select(*order, F.length("_raw").alias("_size")).distinct()
    sizes = sized.orderBy(*order).limit(4 * TRAIN_PER_LABEL).collect()
    before = np.cumsum([r["_size"] for r in sizes]) - [r["_size"] for r in sizes]
    last = [r["_h"] for r, upto in zip(sizes, before) if upto < TRAIN_BYTES][-1:]
    # Rows that repeat id, text and label are one: they could be any number.
    found = []
    if last:
        found = keyed.filter(F.col("_h") <= last[0]).select(*order, "_raw").distinct().collect()
    found.sort(key=lambda r: (r["_h"], r["_label"]))
    chunks = [chunked(bytes(r["_raw"])) for r in found]
    picked_labels = np.array([r["_label"] for r in found])
    total = sum(counts.values())
    share = (counts.get(1, 0) + 1) / (total + 2)
    return chunks, picked_labels, share


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add ``score`` and ``predicted`` to every row, with the columns of ``keep`` or all.

    The network learns from a bounded sample of the labelled rows where ``learn`` (over the
    columns of ``labels``) holds. A score is the probability of label 1 and reads nothing but
    the bytes of the whole text; NULL and empty texts are one blank chunk. ``predicted`` is 1
    from the threshold on. Without any label all scores are 0.5. Repeated rows score alike;
    columns of the two names in the input are replaced; an empty input gives no rows.
    """
    docs = docs.drop("score", "predicted")
    net = train(*sample(docs, labels, learn, id_col, text_col, label_col))
    keep = docs.columns if keep is None else keep
    schema = T.StructType(
        [
            *(docs.schema[name] for name in keep),
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(len(keep)).cast(pa.binary())]
            scores = score_texts(net, texts)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(keep)],
                    pa.array(scores, pa.float64()),
                    pa.array((scores >= threshold).astype(np.int32)),
                ],
                names=schema.names,
            )

    return docs.select(*keep, F.col(text_col).alias("_text")).mapInArrow(run, schema)
