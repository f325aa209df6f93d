"""Quality classifier: a byte-level convolutional network in numpy.

Learned filters read every window of ``WIDTH`` bytes. The text is covered by
overlapping chunks of two ``HALF``-byte halves, each chunk starting at every half.
Filter responses are max-pooled within a chunk; a document's vector holds their mean
and their maximum over all its chunks, and one logistic layer makes a probability of
it. Only the text's bytes enter a score.

It is fitted by gradient descent on at most ``SAMPLE`` labelled rows (taken in the order
of a hash of doc_id) whose crc32(doc_id) mod 5 is not 0; the rest is held out. A text of
more than ``SAMPLE_CHARS`` characters teaches by a window of so many, from a place its
doc_id's hash draws. Seeds are fixed. Scoring covers
whole texts in slices, so memory does not grow with a text's length.

Defined cases: a NULL or empty text gets the score of one empty chunk; a NULL doc_id is
scored, never learned from and not held out; of several labels of one doc_id the
largest counts; without labels every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sellerbooks.llm.common import numbered, spread, text_blocks

FILTERS = 8
WIDTH = 5
HALF = 128
SAMPLE = 3000
SAMPLE_CHARS = 1 << 15
#: Passes over the sample; a small sample gets more, up to STEPS batches.
EPOCHS = 10
STEPS = 800
BATCH = 48
RATE = 0.02
SEED = 11
FOLDS = 5
LEAST = 0.3
SLICE = 1 << 18


@dataclass
class Network:
    """table[w, byte, filter]: what a byte at place w of a window adds to a filter."""

    table: np.ndarray
    bias: np.ndarray
    weight: np.ndarray
    offset: float

    @staticmethod
    def empty() -> Network:
        return Network(
            np.zeros((WIDTH, 256, FILTERS), np.float32), np.zeros(FILTERS, np.float32), np.zeros(2 * FILTERS), 0.0
        )


def lay_out(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts padded with zeros to whole halves: bytes, which of them are text, and halves per text."""
    lengths = np.diff(offsets)
    halves = np.maximum(-(-lengths // HALF), 1)
    starts = np.concatenate([[0], np.cumsum(halves)]) * HALF
    padded = np.zeros(int(starts[-1]) + WIDTH, dtype=np.uint8)
    owner = np.repeat(starts[:-1] - offsets[:-1], lengths)
    place = np.arange(offsets[0], offsets[-1]) + owner
    padded[place] = data
    real = np.zeros(int(starts[-1]) + WIDTH, dtype=bool)
    real[place] = True
    return padded, real, halves


def responses(net: Network, padded: np.ndarray, real: np.ndarray, ends: np.ndarray, low: int, high: int) -> np.ndarray:
    """Filter responses of the windows that start in [low, high); a window stops at its text's end."""
    out = np.repeat(net.bias[None, :], high - low, axis=0)
    for w in range(WIDTH):
        part = net.table[w][padded[low + w : high + w]]
        if w:
            # What lies beyond the end of the window's own text counts as nothing.
            outside = np.flatnonzero(ends[low:high] <= np.arange(low + w, high + w))
            part[outside] = 0
        out += part
    out[~real[low:high]] = 0
    return np.maximum(out, 0, out=out)


def _ends(real: np.ndarray, halves: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    starts = np.concatenate([[0], np.cumsum(halves)[:-1]]) * HALF
    return np.concatenate([np.repeat(starts + lengths, halves * HALF), np.zeros(WIDTH, np.int64)])


def half_maxima(net: Network, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    padded, real, halves = lay_out(data, offsets)
    ends = _ends(real, halves, np.diff(offsets))
    total = len(padded) - WIDTH
    parts = [
        responses(net, padded, real, ends, low, min(low + SLICE, total)).reshape(-1, HALF, FILTERS).max(axis=1)
        for low in range(0, total, SLICE)
    ]
    return np.concatenate(parts), halves


def document_vectors(maxima: np.ndarray, halves: np.ndarray) -> np.ndarray:
    """Mean and maximum over a document's chunks; a chunk is two neighbouring halves, or a lone half."""
    last = np.cumsum(halves) - 1
    chunk = maxima.copy()
    chunk[:-1] = np.maximum(maxima[:-1], maxima[1:])
    chunk[last] = maxima[last]  # no neighbour within the text
    count = np.maximum(halves - 1, 1)
    first = np.concatenate([[0], last[:-1] + 1])
    use = np.ones(len(chunk), dtype=bool)
    use[last[halves > 1]] = False  # already in the chunk before
    sums = np.add.reduceat(chunk * use[:, None], first, axis=0)
    return np.concatenate([sums / count[:, None], np.maximum.reduceat(chunk, first, axis=0)], axis=1)


def scores(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    vectors = document_vectors(*half_maxima(net, data, offsets))
    return 1 / (1 + np.exp(-np.clip(vectors @ net.weight + net.offset, -500, 500)))


class _Adam:
    def __init__(self, *values: np.ndarray):
        self.values, self.steps = values, 0
        self.m, self.v = [np.zeros_like(x) for x in values], [np.zeros_like(x) for x in values]

    def step(self, gradients, rate: float) -> None:
        self.steps += 1
        for x, g, m, v in zip(self.values, gradients, self.m, self.v):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.99**self.steps)) + 1e-8)


def fit(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, steps: int = STEPS, seed: int = SEED) -> Network:
    """Minimise the log loss; the pooled maxima pass gradients to the windows that attained them."""
    net = Network.empty()
    if not len(texts):
        return net
    rng = np.random.default_rng(seed)
    net.table[:] = rng.normal(0, 0.3, net.table.shape)
    net.weight[:] = rng.normal(0, 0.3, 2 * FILTERS)
    base = np.clip(labels.mean(), 0.02, 0.98)
    offset = np.array([np.log(base / (1 - base))])
    adam = _Adam(net.table, net.bias, net.weight, offset)
    lanes = np.arange(FILTERS)
    epochs = max(epochs, steps * BATCH // len(texts))
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            data = np.frombuffer(b"".join(texts[i] for i in own), dtype=np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(texts[i]) for i in own])])
            padded, real, halves = lay_out(data, offsets)
            ends = _ends(real, halves, np.diff(offsets))
            total = len(padded) - WIDTH
            cube = responses(net, padded, real, ends, 0, total).reshape(-1, HALF, FILTERS)
            peak = cube.argmax(axis=1)
            maxima = np.take_along_axis(cube, peak[:, None, :], axis=1)[:, 0, :]
            vectors = document_vectors(maxima, halves)
            p = 1 / (1 + np.exp(-(vectors @ net.weight + offset[0])))
            error = (p - labels[own]) / len(own)
            g_weight = vectors.T @ error + 1e-4 * net.weight
            g_vector = error[:, None] * net.weight[None, :]
            # Back to the half that supplied each chunk's maximum.
            last = np.cumsum(halves) - 1
            first = np.concatenate([[0], last[:-1] + 1])
            doc = np.repeat(np.arange(len(own)), halves)
            g_half = np.zeros_like(maxima, dtype=np.float64)
            right = np.zeros(maxima.shape, dtype=bool)
            right[:-1] = maxima[1:] > maxima[:-1]
            right[last] = False
            use = np.ones(len(maxima), dtype=bool)
            use[last[halves > 1]] = False
            g_chunk = (g_vector[:, :FILTERS] / np.maximum(halves - 1, 1)[:, None])[doc] * use[:, None]
            chunk = np.where(right, np.concatenate([maxima[1:], maxima[-1:]]), maxima)
            top = chunk == np.maximum.reduceat(chunk, first, axis=0)[doc]
            share = np.add.reduceat(top.astype(float), first, axis=0)[doc]
            g_chunk = g_chunk + g_vector[:, FILTERS:][doc] * top / share
            g_half += np.where(right, 0, g_chunk)
            g_half[1:] += np.where(right, g_chunk, 0)[:-1]
            g_half = np.where(maxima > 0, g_half, 0)
            place = peak + (np.arange(len(maxima)) * HALF)[:, None]
            g_table = np.zeros((WIDTH, 256 * FILTERS))
            for w in range(WIDTH):
                inside = place + w < ends[place]
                index = (padded[place + w].astype(np.int64) * FILTERS + lanes)[inside]
                g_table[w] = np.bincount(index, weights=g_half[inside], minlength=256 * FILTERS)
            g_table = g_table.reshape(net.table.shape) + 1e-5 * net.table
            rate = RATE * (1 - epoch / epochs) + 0.002
            adam.step([g_table.astype(np.float32), g_half.sum(axis=0).astype(np.float32), g_weight, np.array([error.sum()])], rate)
    net.offset = float(offset[0])
    return net


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Network:
    """Fit on the bounded sample of labelled documents."""
    known = labels.filter("doc_id is not null and quality is not null").filter(fold(F.col("doc_id")) != 0)
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    more = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0))
    window = F.substring("text", (F.pmod(F.xxhash64("doc_id"), more + 1) + 1).cast("int"), F.lit(SAMPLE_CHARS))
    texts = docs.filter("text is not null").select("doc_id", window.alias("text"))
    rows = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "quality")
    # Equal doc_ids could make the sample larger than its bound.
    rows = rows.orderBy("doc_id", "text").limit(sample).toPandas()
    return fit([t.encode("utf-8", "replace") for t in rows["text"]], rows["quality"].to_numpy(np.float64))


def score_column(net: Network, text: Column) -> Column:
    """The score of a text column; the other columns stay where they are."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        found = [scores(net, data, offsets) for _, _, data, offsets in text_blocks(texts)]
        return pa.array(np.concatenate(found) if found else np.zeros(0))

    return score(text.cast("string"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""
    scored = docs.select("doc_id", score_column(train(docs, labels), F.col("text")).alias("score"))
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    kept = (F.col("score") >= LEAST).cast("int")
    return scored.select("doc_id", held.alias("held_out"), "score", kept.alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, with their columns."""
    rows = numbered(docs)
    scored = rows.withColumn("_score", score_column(train(docs, labels), F.col("doc.text")))
    return scored.filter(F.col("_score") >= LEAST).select(*spread(rows, docs.columns))
