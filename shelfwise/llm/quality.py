"""Quality scores from a byte-level convolutional network in numpy.

A text's bytes run through ``FILTERS`` learned filters of ``WIDTH`` bytes, placed every
``STRIDE`` bytes, over chunks of ``CHUNK`` bytes that overlap by half and cover the whole text.
Each chunk keeps every filter's maximum; the mean and the maximum of these over a text's
chunks, and its length, feed one hidden layer and give one probability.

A filter over bytes is a sum of table rows, one per place, so the forward pass is table look-ups
for all texts of a chunk of rows together. Training is gradient descent (Adam) on the driver,
over at most ``FIT_ROWS`` labelled rows taken by hash order, whole texts in steps; max-pooling
passes the gradient only to the places that won. The parameters have a fixed size.

Defined cases: a NULL or empty text is one chunk of padding; without labels or with one class
only, every score is that share (0.5 without any); NULL labels teach nothing; a doc_id with both
labels counts as good; repeated rows are scored each by its own text; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import arrays as A
from shelfwise.llm.common import extended, map_arrow
from shelfwise.llm.toxicity import fold, labelled

FILTERS, WIDTH, STRIDE = 24, 6, 3
#: Bytes of a chunk; the next begins half a chunk later.
CHUNK = 384
HIDDEN = 16
#: Labelled rows to fit on, at most; bytes of one training step; rounds over the rows.
FIT_ROWS, STEP_BYTES, ROUNDS = 6_000, 200_000, 6
#: A sampled text beyond this counts for the fit in pieces of this many bytes, each with its label.
PIECE = 60_000
_PAD = 256


def _layout(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text, how many half-chunks it has; all halves together in order."""
    halves = np.maximum(-(-sizes // (CHUNK // 2)), 1)
    return halves, np.concatenate(([0], np.cumsum(halves)))


def _padded(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes as one row per half-chunk (padding at the end of a text), and each text's first row."""
    half = CHUNK // 2
    halves, first = _layout(np.diff(offsets))
    out = np.full(first[-1] * half, _PAD, dtype=np.int16)
    out[A.within(first[:-1] * half, np.diff(offsets))] = buf
    return out, first


class Net:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.table = (rng.normal(size=(WIDTH, 257, FILTERS)) * 0.3).astype(np.float32)
        self.table[:, _PAD] = 0
        self.bias = np.zeros(FILTERS, dtype=np.float32)
        inputs = 2 * FILTERS + 1
        self.w1 = (rng.normal(size=(inputs, HIDDEN)) / np.sqrt(inputs)).astype(np.float32)
        self.b1 = np.zeros(HIDDEN, dtype=np.float32)
        self.w2 = (rng.normal(size=HIDDEN) / np.sqrt(HIDDEN)).astype(np.float32)
        self.b2 = np.zeros(1, dtype=np.float32)

    names = ("table", "bias", "w1", "b1", "w2", "b2")

    def pooled(self, buf: np.ndarray, offsets: np.ndarray, places: bool = False):
        """Per half-chunk pair the maximum of every filter, and the first chunk of each text."""
        data, first = _padded(buf, offsets)
        half, steps = CHUNK // 2, (CHUNK // 2) // STRIDE
        n = first[-1]
        # Filters that begin in a half may end in the next one of the row; texts end in padding.
        wide = np.concatenate((data, np.full(WIDTH, _PAD, dtype=np.int16)))
        out = np.empty((n, FILTERS), dtype=np.float32)
        won = np.empty((n, FILTERS), dtype=np.int64) if places else None
        for a in range(0, n, 512):
            b = min(a + 512, n)
            at = (np.arange(a, b)[:, None] * half + np.arange(0, half, STRIDE)).ravel()
            h = self.table[0][wide[at]]
            for k in range(1, WIDTH):
                h += self.table[k][wide[at + k]]
            h = h.reshape(b - a, steps, FILTERS)
            if places:
                best = h.argmax(axis=1)
                won[a:b] = (np.arange(a, b) * half)[:, None] + best * STRIDE
                out[a:b] = np.take_along_axis(h, best[:, None], axis=1)[:, 0]
            else:
                out[a:b] = h.max(axis=1)
        # A chunk is two halves in a row of one text; a text of one half is one chunk.
        last = np.zeros(n, dtype=bool)
        last[first[1:] - 1] = True
        following = np.where(last, np.arange(n), np.arange(n) + 1)
        nxt = out[following]
        chunk = np.maximum(out, nxt)
        if places:
            won = np.where(nxt > out, won[following], won)
        return np.maximum(chunk + self.bias, 0), first, won, wide

    def inputs(self, chunk: np.ndarray, first: np.ndarray, sizes: np.ndarray):
        counts = np.diff(first)
        mean = np.add.reduceat(chunk, first[:-1], axis=0) / counts[:, None]
        most = np.maximum.reduceat(chunk, first[:-1], axis=0)
        return np.concatenate((mean, most, np.log1p(sizes)[:, None].astype(np.float32) / 10), axis=1)

    def logits(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if len(offsets) < 2:
            return np.zeros(0)
        chunk, first, _, _ = self.pooled(buf, offsets)
        x = self.inputs(chunk, first, np.diff(offsets))
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2[0]

    def gradients(self, buf, offsets, y, weight):
        chunk, first, won, wide = self.pooled(buf, offsets, places=True)
        x = self.inputs(chunk, first, np.diff(offsets))
        hidden = np.maximum(x @ self.w1 + self.b1, 0)
        p = 1 / (1 + np.exp(-np.clip(hidden @ self.w2 + self.b2[0], -30, 30)))
        d = ((p - y) * weight / len(y)).astype(np.float32)
        dh = d[:, None] * self.w2 * (hidden > 0)
        dx = dh @ self.w1.T
        counts = np.diff(first)
        own = np.repeat(np.arange(len(y)), counts)
        most = x[:, FILTERS : 2 * FILTERS][own]
        dc = dx[:, :FILTERS][own] / counts[own][:, None] + dx[:, FILTERS : 2 * FILTERS][own] * (chunk == most)
        dc = (dc * (chunk > 0)).astype(np.float32)
        table = np.zeros_like(self.table)
        columns = np.broadcast_to(np.arange(FILTERS), dc.shape).ravel()
        for k in range(WIDTH):
            flat = wide[won + k].ravel().astype(np.int64) * FILTERS + columns
            table[k] = np.bincount(flat, weights=dc.ravel(), minlength=257 * FILTERS).reshape(257, FILTERS)
        table[:, _PAD] = 0
        return {"table": table, "bias": dc.sum(axis=0), "w1": x.T @ dh, "b1": dh.sum(axis=0), "w2": hidden.T @ d, "b2": d.sum(keepdims=True)}


def fit(texts: list[bytes], y: np.ndarray, rounds: int = ROUNDS) -> Net:
    """A network for the texts' 0/1 labels, rarer label weighed up; the same for the same rows."""
    net = Net()
    cut = [(t[k : k + PIECE], v) for t, v in zip(texts, y) for k in range(0, max(len(t), 1), PIECE)]
    texts, y = [t for t, _ in cut], np.array([v for _, v in cut], dtype=np.float32)
    share = float(y.mean())
    if share in (0.0, 1.0):
        net.w2[:] = 0
        net.b2[:] = np.log((share + 1e-3) / (1 - share + 1e-3))
        return net
    rng = np.random.default_rng(11)
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    moments = {n: (np.zeros_like(getattr(net, n)), np.zeros_like(getattr(net, n))) for n in net.names}
    step = 0
    sizes = np.array([len(t) for t in texts])
    total = rounds * max(1, int(sizes.sum() / STEP_BYTES))
    for _ in range(rounds):
        order = rng.permutation(len(texts))
        steps = np.cumsum(sizes[order]) // STEP_BYTES
        for rows in np.split(order, np.flatnonzero(np.diff(steps)) + 1):
            buf, offsets = A.text_bytes(pa.array([texts[r] for r in rows], pa.large_binary()))
            grads = net.gradients(buf, offsets, y[rows], weight[rows])
            step += 1
            rate = 0.01 * max(0.05, 1 - step / (total + 1))
            for name in net.names:
                m, v = moments[name]
                m += 0.1 * (grads[name] - m)
                v += 0.01 * (grads[name] ** 2 - v)
                value = getattr(net, name)
                value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    # The rows were weighed to equal classes; the intercept takes the true shares again.
    net.b2 += np.float32(np.log(share / (1 - share)))
    return net


def train(documents: DataFrame, labels: DataFrame) -> Net:
    """Fit on the labelled rows (never the held-out fold) that come first by hash."""
    rows = labelled(documents, labels, "quality", FIT_ROWS).select("doc_id", F.col("text").cast("binary").alias("text"), "label")
    # Rows that share an id teach once.
    sample = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label")).toPandas()
    sample = sample.sort_values("doc_id")
    if not len(sample):
        net = Net()
        net.w2[:] = 0
        return net
    texts = [bytes(t) if t is not None else b"" for t in sample["text"]]
    return fit(texts, (sample["label"] == 1).to_numpy(dtype=np.float32))


def score(documents: DataFrame, net: Net) -> DataFrame:
    """The rows without ``text`` and with ``score``: the chance of label 1."""
    shared = documents.sparkSession.sparkContext.broadcast({n: getattr(net, n) for n in net.names})

    def run(batches):
        model = Net()
        for name, value in shared.value.items():
            setattr(model, name, value)
        for batch in A.chunks(batches):
            buf, offsets = A.text_bytes(batch.column("text"))
            p = 1 / (1 + np.exp(-np.clip(model.logits(buf, offsets), -30, 30).astype(np.float64)))
            keep = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(p)], names=[*keep, "score"])

    return map_arrow(documents, run, extended(documents, "score double", ("text",)))


def op7_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return score(documents.select("doc_id", "text"), train(documents, labels)).select(
        "doc_id",
        F.coalesce(fold() == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
