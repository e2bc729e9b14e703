"""Toxic passages by maximum-scoring segments.

A word's tokens are the word and its beginnings of ``STEMS`` bytes. Every token has a log-odds
score: how much more often it stands in toxic than in other training documents, with an
informative Dirichlet prior from all training tokens, less ``CAUTION`` standard errors. A word
counts by its strongest token. Tokens live in ``CELLS`` hashed cells, so the table's size is
fixed and every word of every text counts. Words without sure evidence cost a constant drift. A linear scan
finds all maximal-scoring segments of a text; extreme-value statistics (the law of the best
segment among n words that hold no signal) turn segment scores into surprise, which a logistic
curve, fitted on held-back training rows, turns into a probability.

Rows fall by ``crc32(doc_id) mod 5``: remainder 0 is never learned from, 1 to 3 give the word
table, 4 the calibration.

Defined cases: a NULL or wordless text has no segment and gets the lowest score; without labels,
or with one class only, all scores are the share of toxic training labels (0 without any);
NULL labels teach nothing; rows that repeat a doc_id are scored each by its own text; a label
row that repeats counts once, and a doc_id with both labels counts as toxic; other columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import arrays as A
from shelfwise.llm.common import SAMPLE_TEXT_BYTES, extended, hand_off, map_arrow
from shelfwise.llm.decontaminate import words_of

CELL_BITS = 19
CELLS = 1 << CELL_BITS
STEMS = (6, 7, 8, 10)
CAUTION = 1.5
#: Weight of the prior, as a share of all training tokens.
PRIOR = 0.05
#: Cost of a word without evidence.
DRIFT = 0.1
#: Segments below this surprise (negative natural log of their chance) are not significant.
SIGNIFICANT = 1.0
#: Labelled ids to learn from, at most; any more are left out by hash.
FIT_ROWS = 30_000


def fold(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id's text, modulo 5 (NULL id: NULL)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 if isinstance(doc_id, str) else doc_id


def labelled(documents: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, text, label) for at most ``most`` ids that may be learned from, first by hash.

    The ids' number is bounded, so they are broadcast and the texts need no shuffle.
    """
    known = (
        labels.where(F.col(label).isNotNull() & (fold() != 0))
        .groupBy("doc_id")
        .agg(F.max(F.col(label)).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    texts = documents.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= SAMPLE_TEXT_BYTES)
    return texts.select("doc_id", "text").join(F.broadcast(known), "doc_id")


def _tokens(buf: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Cells of the whole words, then (rows, cells) of the beginnings of the longer words."""
    sums = A.prefix_hashes(buf)

    def cells(hashes):
        return (A.mix(hashes) >> np.uint64(64 - CELL_BITS)).astype(np.int64)

    yield np.arange(len(start)), cells(A.range_hashes(sums, start, end))
    for size in STEMS:
        rows = np.flatnonzero(end - start > size)
        salt = np.uint64(size) << np.uint64(56)
        yield rows, cells(A.range_hashes(sums, start[rows], start[rows] + size) ^ salt)


def _count_words(batches):
    """Per task: cell, its tokens in toxic texts, in others (one row per cell in use)."""
    counts = np.zeros((2, CELLS), dtype=np.int64)
    for batch in A.chunks(batches):
        buf, offsets, start, end = words_of(batch.column("text"))
        toxic = batch.column("label").to_numpy(zero_copy_only=False)[A.owners(start, offsets)] == 1
        for rows, cells in _tokens(buf, start, end):
            counts[0] += np.bincount(cells[toxic[rows]], minlength=CELLS)
            counts[1] += np.bincount(cells[~toxic[rows]], minlength=CELLS)
    used = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used), pa.array(counts[0][used]), pa.array(counts[1][used])], names=["cell", "toxic", "other"]
    )


def _gains(table: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Score of every word: that of its strongest token."""
    out = np.full(len(start), -DRIFT, dtype=np.float32)
    for rows, cells in _tokens(buf, start, end):
        out[rows] = np.maximum(out[rows], table[cells])
    return out


def _count_scores(table):
    """Map function: how many words of the texts have each (rounded) score."""

    def run(batches):
        for batch in A.chunks(batches):
            buf, _, start, end = words_of(batch.column("text"))
            value, count = np.unique(np.round(_gains(table.value, buf, start, end), 2), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value.astype(np.float64)), pa.array(count)], names=["score", "n"])

    return run


def word_scores(toxic: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Cautious log-odds of each cell with an informative Dirichlet prior; -DRIFT where not sure."""
    both = toxic + other
    total = max(both.sum(), 1)
    weight = PRIOR * total
    prior = weight * (both + 1e-3) / (total + 1e-3 * len(both))
    a, b = toxic + prior, other + prior
    rest_a, rest_b = toxic.sum() + weight - a, other.sum() + weight - b
    odds = np.log(a / np.maximum(rest_a, 1e-9)) - np.log(b / np.maximum(rest_b, 1e-9))
    sure = odds - CAUTION * np.sqrt(1 / a + 1 / b)
    return np.where((sure > 0) & (toxic >= 3), sure, -DRIFT)


def segments(places: np.ndarray, gains: np.ndarray, n: int) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first word, end, score) of a text with ``n`` words.

    Only words with a gain are listed; each other word costs DRIFT. Linear: every gain enters
    a stack of disjoint candidates once and leaves it at most once.
    """
    # Sum before, sum after, first, end, and the nearest entry below with a smaller sum before.
    stack: list[tuple[float, float, int, int, int]] = []
    total, last = 0.0, 0
    for place, gain in zip(places.tolist(), gains.tolist()):
        total -= DRIFT * (place - last)
        before, total, first = total, total + gain, place
        last = place + 1
        while True:
            k = len(stack) - 1
            while k >= 0 and stack[k][0] >= before:
                k = stack[k][4]
            if k < 0 or stack[k][1] >= total:
                # Candidates after k lie lower or end higher; they stay beside the new one.
                stack.append((before, total, first, place + 1, k))
                break
            before, first = stack[k][0], stack[k][2]
            del stack[k:]
    return [(first, end, after - before) for before, after, first, end, _ in stack]


def decay(scores: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of E[exp(x * score)] = 1 over words without signal."""
    p = counts / max(counts.sum(), 1)
    if not (p[scores > 0] > 0).any() or (p * scores).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while (p * np.exp(np.minimum(high * scores, 700))).sum() < 1 and high < 64:
        low, high = high, 2 * high
    low = max(low, 1e-9)
    for _ in range(60):
        mid = (low + high) / 2
        if (p * np.exp(np.minimum(mid * scores, 700))).sum() < 1:
            low = mid
        else:
            high = mid
    return high


def _surprise(score: float, rate: float, n: int) -> float:
    """Negative log chance that the best segment among n signal-free words scores as high."""
    expected = n * math.exp(-rate * score)
    return -math.log(-math.expm1(-expected)) if expected > 1e-12 else rate * score - math.log(n)


def _scan(table, rate: float, texts: bool = False):
    """Map function from texts to their surprise and significant segments; ``texts``: they stay."""

    def run(batches):
        scores = table.value
        for batch in A.chunks(batches):
            buf, offsets, start, end = words_of(batch.column("text"))
            gain = _gains(scores, buf, start, end)
            first = np.searchsorted(start, offsets)
            hot = np.flatnonzero(gain > 0)
            bounds = np.searchsorted(hot, first)
            points = A.code_points(buf)
            surprise = np.zeros(batch.num_rows)
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for d in np.flatnonzero(np.diff(bounds)):
                own = hot[bounds[d] : bounds[d + 1]]
                n = int(first[d + 1] - first[d])
                for a, b, s in segments(own - first[d], gain[own], n):
                    u = _surprise(s, rate, n)
                    if u >= SIGNIFICANT:
                        w, base = first[d] + a, points[offsets[d]]
                        surprise[d] += u
                        found[d].append(
                            {"start": int(points[start[w]] - base), "end": int(points[end[first[d] + b - 1]] - base), "surprise": u}
                        )
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in batch.schema.names if texts or n != "text"),
                    pa.array(surprise),
                    pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("surprise", pa.float64())]))),
                ],
                names=[*(n for n in batch.schema.names if texts or n != "text"), "surprise", "segments"],
            )

    return run


_FOUND = "surprise double, segments array<struct<start: long, end: long, surprise: double>>"


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by damped Newton steps with a slight ridge."""
    w = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (y - p) - 1e-3 * w
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2), grad)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


class Model:
    """Word table, decay rate and calibration; fixed size."""

    def __init__(self, table: np.ndarray, rate: float, slope: float, intercept: float):
        self.table, self.rate, self.slope, self.intercept = table, rate, slope, intercept


def train(documents: DataFrame, labels: DataFrame) -> Model:
    rows = hand_off(labelled(documents, labels, "toxic", FIT_ROWS), "toxic-labels")
    counted = map_arrow(rows.where(fold() != 4).select("text", "label"), _count_words, "cell long, toxic long, other long")
    counts = counted.groupBy("cell").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).toPandas()
    toxic, other = np.zeros(CELLS), np.zeros(CELLS)
    toxic[counts["cell"]] = counts["toxic"]
    other[counts["cell"]] = counts["other"]
    table = word_scores(toxic, other).astype(np.float32)
    shared = documents.sparkSession.sparkContext.broadcast(table)
    calm = map_arrow(rows.where((fold() != 4) & (F.col("label") == 0)).select("text"), _count_scores(shared), "score double, n long")
    spread = calm.groupBy("score").agg(F.sum("n").alias("n")).toPandas()
    rate = decay(spread["score"].to_numpy(), spread["n"].to_numpy(dtype=float)) if len(spread) else 1.0
    held = map_arrow(rows.where(fold() == 4).select("label", "text"), _scan(shared, rate), f"label int, {_FOUND}")
    fit: pd.DataFrame = held.select("label", "surprise").limit(FIT_ROWS).toPandas()
    y = (fit["label"] == 1).to_numpy(dtype=float)
    if not len(y) or y.min() == y.max():
        share = float(toxic.sum() > 0) * (y.mean() if len(y) else 0.0)
        return Model(table, rate, 0.0, math.log((share + 1e-6) / (1 - share + 1e-6)))
    return Model(table, rate, *fit_curve(np.log1p(fit["surprise"].to_numpy()), y))


def score(documents: DataFrame, model: Model, texts: bool = False) -> DataFrame:
    """The rows (with ``texts``: and their text) with ``surprise``, significant ``segments`` and ``score``, the chance to be toxic."""
    shared = documents.sparkSession.sparkContext.broadcast(model.table)
    found = map_arrow(documents, _scan(shared, model.rate, texts), extended(documents, _FOUND, () if texts else ("text",)))
    logit = F.log1p("surprise") * model.slope + model.intercept
    return found.withColumn("score", 1 / (1 + F.exp(-logit)))


def without_toxic(documents: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """The documents, columns as they are, whose score is below ``limit``."""
    others = F.struct(*[F.col(f"`{c}`") for c in documents.columns if c != "text"])
    scored = score(documents.select(others.alias("row"), "text"), train(documents, labels), texts=True)
    kept = scored.where(F.col("score") < limit)
    return kept.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in documents.columns])


def op8_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(documents, labels)
    return score(documents.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(fold() == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("segments").alias("n_segments"),
    )
