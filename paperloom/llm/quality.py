"""Text quality by a small convolutional network over bytes, in numpy.

A text's UTF-8 bytes are embedded; filters of WIDTH bytes go over chunks that begin every
STRIDE bytes and so overlap, from the first byte to the last; each filter keeps its
largest response in the whole text (max pooling), and a logistic layer makes one
probability of these. Long texts are read in pieces that overlap by a chunk, so the
memory is bounded and the result is that of the whole text.

Defined results: a null or empty text counts as one chunk of padding and gets a score as
well; repeated rows are scored alike; an empty table gives an empty table; other columns
are kept as they are, whatever their names. Without labelled rows of both classes the
score is the share of good ones (0.5 if there are none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import appended, bytes_of, held_out, small_batches, training_sample, unused

WIDTH, STRIDE, DEPTH, FILTERS = 8, 4, 8, 32
#: The most labelled texts of a class that the network is fitted on.
PER_CLASS = 3000
EPOCHS, BATCH, RATE, DECAY = 14, 32, 0.01, 1e-4
#: Bytes of a piece; also about the bytes that go through the filters at once.
PIECE = 1 << 19
LEAST_GOOD = 0.3


@dataclass
class Network:
    embed: np.ndarray  # 256 x DEPTH
    filters: np.ndarray  # WIDTH x DEPTH x FILTERS
    bias: np.ndarray  # FILTERS
    out: np.ndarray  # FILTERS
    prior: float
    constant: float | None = None

    @staticmethod
    def fresh(seed: int = 7) -> Network:
        r = np.random.default_rng(seed)
        return Network(r.normal(0, 0.5, (256, DEPTH)).astype("f4"), r.normal(0, (WIDTH * DEPTH) ** -0.5, (WIDTH, DEPTH, FILTERS)).astype("f4"), np.zeros(FILTERS, "f4"), r.normal(0, FILTERS**-0.5, FILTERS).astype("f4"), 0.0)

    def responses(self, padded: np.ndarray) -> np.ndarray:
        """Of every chunk in bytes whose number is a multiple of STRIDE; a row fewer than there are strides."""
        x = self.embed[padded].reshape(-1, STRIDE * DEPTH)
        halves = self.filters.reshape(WIDTH // STRIDE, STRIDE * DEPTH, FILTERS)
        both = x @ np.concatenate(list(halves), axis=1)
        n = len(x) - 1
        return both[:n, :FILTERS] + both[1:, FILTERS:]

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.bias, 0).astype("f8") @ self.out.astype("f8") + self.prior
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _pieces(ends: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(text, first byte, end) of every piece."""
    for k in range(len(ends) - 1):
        a, b = int(ends[k]), int(ends[k + 1])
        yield from ((k, s, min(b, s + PIECE)) for s in range(a, max(b, a + 1), PIECE))


def _padded(data: np.ndarray, ends: np.ndarray, group: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The group's pieces one after another, each with the chunk's tail that follows it, and where each begins in strides."""
    sizes = np.array([-(-(b - a) // STRIDE) + 1 if b > a else 2 for _, a, b in group])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(starts[-1] * STRIDE, np.uint8)
    for (k, a, b), s in zip(group, starts, strict=False):
        whole = min(int(ends[k + 1]), b + WIDTH - STRIDE)
        part = data[a:whole][: (-(-(b - a) // STRIDE) + 1) * STRIDE]
        out[s * STRIDE : s * STRIDE + len(part)] = part
    return out, starts


def pooled(net: Network, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The largest response of every filter in each text."""
    best = np.full((len(ends) - 1, FILTERS), -np.inf, "f4")
    group: list[tuple[int, int, int]] = []
    size = 0

    def flush() -> None:
        buffer, starts = _padded(data, ends, group)
        answers = net.responses(buffer)
        # the last row of a piece would read into the next one
        answers[starts[1:-1] - 1] = -np.inf
        top = np.maximum.reduceat(answers, starts[:-1], axis=0)
        np.maximum.at(best, [k for k, *_ in group], top)

    for piece in _pieces(ends):
        group.append(piece)
        size += piece[2] - piece[1] + 2 * STRIDE
        if size >= PIECE:
            flush()
            group, size = [], 0
    if group:
        flush()
    return best


def fit(rows: list[tuple[str, int]], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """The network fitted to labelled texts by Adam; the gradient of max pooling goes to the chunk that won."""
    net = Network.fresh(seed)
    y = np.array([c for _, c in rows], "f8")
    if not 0 < y.sum() < len(y):
        net.constant = float(y.mean()) if len(y) else 0.5
        return net
    texts = [np.frombuffer(t.encode("utf-8", "replace"), np.uint8) for t, _ in rows]
    weight = np.where(y == 1, 0.5 * len(y) / y.sum(), 0.5 * len(y) / (len(y) - y.sum()))
    r = np.random.default_rng(seed)
    names = ("embed", "filters", "bias", "out")
    moments = {n: [np.zeros_like(getattr(net, n)), np.zeros_like(getattr(net, n))] for n in names}
    prior, step = [0.0, 0.0], 0
    for epoch in range(epochs):
        order = r.permutation(len(texts))
        rate = RATE * (1 - epoch / epochs) + 1e-3
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            # a random first byte, so that patterns are learnt at every place in a stride
            part = [texts[k][(int(r.integers(STRIDE)) if len(texts[k]) > WIDTH else 0) :] for k in pick]
            ends = np.concatenate([[0], np.cumsum([len(p) for p in part])]).astype(np.int64)
            group = [(i, int(ends[i]), int(ends[i + 1])) for i in range(len(part))]
            buffer, starts = _padded(np.concatenate(part), ends, group)
            answers = net.responses(buffer)
            answers[starts[1:-1] - 1] = -np.inf
            won = np.stack([answers[a : b - 1 if b < starts[-1] else None].argmax(0) + a for a, b in zip(starts[:-1], starts[1:], strict=True)])
            raw = np.take_along_axis(answers, won, 0) + net.bias
            active = np.maximum(raw, 0)
            p = 1 / (1 + np.exp(-np.clip(active @ net.out + net.prior, -30, 30)))
            d = ((p - y[pick]) * weight[pick] / len(pick)).astype("f4")
            back = d[:, None] * net.out * (raw > 0)
            window = buffer[won[..., None] * STRIDE + np.arange(WIDTH)]  # texts x FILTERS x WIDTH
            seen = net.embed[window]
            grads = {"out": active.T @ d, "bias": back.sum(0), "filters": np.einsum("tf,tfwd->wdf", back, seen, optimize=True)}
            grads["embed"] = np.zeros_like(net.embed)
            np.add.at(grads["embed"], window.reshape(-1), np.einsum("tf,wdf->tfwd", back, net.filters, optimize=True).reshape(-1, DEPTH))
            step += 1
            for n in names:
                g, (m, v), w = grads[n] + DECAY * getattr(net, n), moments[n], getattr(net, n)
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            g = float(d.sum())
            prior = [0.9 * prior[0] + 0.1 * g, 0.999 * prior[1] + 0.001 * g * g]
            net.prior -= rate * (prior[0] / (1 - 0.9**step)) / ((prior[1] / (1 - 0.999**step)) ** 0.5 + 1e-8)
    return net


def probabilities(net: Network, column: pa.Array) -> np.ndarray:
    if net.constant is not None:
        return np.full(len(column), net.constant)
    data, ends = bytes_of(column)
    return net.probability(pooled(net, data, ends))


def score_quality(documents: DataFrame, net: Network, text: str = "text", into: str = "quality_score") -> DataFrame:
    """documents with the probability that a text is good; it replaces a column of the same name."""
    small_batches(documents.sparkSession)
    kept = [c for c in documents.columns if c != into]
    plain = documents.select(*[f"`{c}`" for c in kept])

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(probabilities(net, batch.column(kept.index(text))), pa.float64())], names=[*kept, into])

    return plain.mapInArrow(run, appended(plain.schema, f"`{into}` double"))


def fitted(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Network:
    """The network fitted on at most per_class labelled texts of either class; held-out rows are never read."""
    return fit(training_sample(documents, labels, "quality", per_class))


def decision(score: Column, least: float = LEAST_GOOD) -> Column:
    return (score >= least).cast("int")


def quality_digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_quality(documents.select("doc_id", "text"), fitted(documents, labels))
    return scored.select("doc_id", held_out().alias("held_out"), F.col("quality_score").alias("score"), decision(F.col("quality_score")).alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """documents that count as good, in their own columns, whatever these are named.

    Null and empty texts are decided by their score like others, repeated rows each by
    itself and alike, and very long texts by their whole; an empty table stays empty.
    """
    (score,) = unused(documents.columns, "score")
    scored = score_quality(documents, fitted(documents, labels), into=score)
    return scored.where(decision(F.col(score)) == 1).select(*[f"`{c}`" for c in documents.columns])
