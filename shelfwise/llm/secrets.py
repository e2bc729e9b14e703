"""Secret scans: rules, and a character convolutional network over every candidate.

The rules find assignments, access keys and long hex strings. A candidate is any run of at
least ``LEAST`` key characters with a digit in it. A small network sees the candidate and
``CONTEXT`` characters on both sides, cut into overlapping pieces of ``PIECE`` so that long
candidates are seen whole: learned filters over character embeddings, maximum over all places,
one hidden layer, one chance per kind. It is trained on labelled findings: candidates that a
rule confirms, and those that none does, at most ``FIT_EACH`` of every set of kinds and
``FIT_OTHERS`` others, distinct ones that come first by hash. One in ``HELD`` is never learned from. Each
kind's threshold is the largest of ``GRID`` that still finds ``RECALL`` of the findings not learned from,
counted over all distinct candidates of all texts; if it lets more than ``FALSE_SHARE`` of the
others through, or there are fewer than ``LEAST_HELD`` such findings, the kind adds nothing. Candidates
over the threshold that touch no base span are added.

Defined cases: a NULL or empty text has no spans; rows are independent, repeated ones get the
same answer; other columns stay outside; with no findings to learn from only rules speak.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import arrays as A
from shelfwise.llm.common import extended, hand_off, map_arrow
from shelfwise.llm.spans import Span, finder, schema

KINDS = ["assign", "access", "hex"]
LEAST, CONTEXT, PIECE = 16, 16, 64
#: Findings of every set of kinds, and others, to learn from, at most; the bytes of one, at most (in fitting only).
FIT_EACH, FIT_OTHERS, FIT_BYTES = 1_500, 4_500, 2_048
#: One candidate in so many is kept from learning; findings that a threshold needs at least.
HELD, LEAST_HELD = 4, 20
RECALL, FALSE_SHARE = 0.95, 0.001
EMBED, WIDTH, FILTERS, HIDDEN = 12, 5, 32, 24
#: Places where a threshold can lie: evenly over the log-odds, all below 1.
GRID = np.unique((1 / (1 + np.exp(-np.linspace(-16, 16, 2_049)))).astype(np.float32))

_ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE
)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = np.zeros(256, dtype=bool)
_HEX[48:58] = _HEX[97:103] = True
_KEY = np.zeros(256, dtype=bool)
_KEY[list(b"+/_.=-")] = True
_KEY[48:58] = _KEY[65:91] = _KEY[97:123] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = True


def base_spans(buf: np.ndarray, data: bytes, offsets: np.ndarray) -> list[list[Span]]:
    """Rule matches per document, leftmost and non-overlapping for each kind."""
    found: list[list[Span]] = [[] for _ in range(len(offsets) - 1)]
    # An assignment needs a sign; only texts with one are searched.
    signs = np.flatnonzero((buf == 58) | (buf == 61))
    for d in np.unique(A.owners(signs, offsets)).tolist():
        for m in _ASSIGN.finditer(data, int(offsets[d]), int(offsets[d + 1])):
            if m.end(2) - m.start(2) >= 8:
                found[d].append((m.start(), 0, m.end()))
    at = data.find(b"AKIA")
    while at >= 0:
        d = int(A.owners(np.array([at]), offsets)[0])
        m = _ACCESS.match(data, at, int(offsets[d + 1]))
        if m and m.end() - m.start() >= 16:
            found[d].append((m.start(), 1, m.end()))
        at = data.find(b"AKIA", m.end() if m else at + 1)
    start, end = A.runs(_HEX[buf], offsets)
    long = end - start >= 32
    for s, e, d in zip(start[long].tolist(), end[long].tolist(), A.owners(start[long], offsets).tolist()):
        found[d].append((s, 2, e))
    return found


def candidates(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of key characters that is long enough and has a digit."""
    start, end = A.runs(_KEY[buf], offsets)
    digits = np.concatenate(([0], np.cumsum(_DIGIT[buf])))
    # The outer signs of a run (a full stop, an equals sign) are not part of the candidate.
    solid = np.flatnonzero(_ALNUM[buf])
    if not len(solid):
        return start[:0], end[:0]
    first = np.searchsorted(solid, start)
    last = np.searchsorted(solid, end) - 1
    some = first <= last
    start, end = solid[first[some]], solid[last[some]] + 1
    keep = (end - start >= LEAST) & (digits[end] > digits[start])
    return start[keep], end[keep]


def pieces(buf: np.ndarray, offsets: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of characters with context, which candidate each row belongs to).

    Characters are coded 1 + byte with context marked by + 256; 0 is padding beyond the text.
    """
    width, step = PIECE + 2 * CONTEXT, PIECE // 2
    counts = np.maximum(-(-(end - start - PIECE) // step) + 1, 1)
    which = np.repeat(np.arange(len(start)), counts)
    begin = A.within(np.zeros(len(start), np.int64), counts) * step + start[which] - CONTEXT
    at = begin[:, None] + np.arange(width)
    doc = A.owners(start, offsets)[which]
    inside = (at >= offsets[doc][:, None]) & (at < offsets[doc + 1][:, None])
    # What is left of the piece behind a short candidate is its right context, up to the same width.
    own = (at >= start[which][:, None]) & (at < end[which][:, None])
    near = at < (end[which] + CONTEXT)[:, None]
    codes = buf[np.clip(at, 0, max(len(buf) - 1, 0))].astype(np.int64) + 1 + 256 * ~own
    return np.where(inside & near, codes, 0), which


class Net:
    """Embedding, one layer of filters with maximum over places, one hidden layer, one chance per kind."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.table = (rng.normal(size=(WIDTH, 513, FILTERS)) * 0.3).astype(np.float32)
        self.w1 = (rng.normal(size=(FILTERS, HIDDEN)) / np.sqrt(FILTERS)).astype(np.float32)
        self.b1 = np.zeros(HIDDEN, dtype=np.float32)
        self.w2 = (rng.normal(size=(HIDDEN, len(KINDS))) / np.sqrt(HIDDEN)).astype(np.float32)
        self.b2 = np.full(len(KINDS), -2.0, dtype=np.float32)

    names = ("table", "w1", "b1", "w2", "b2")

    def forward(self, codes: np.ndarray):
        n, places = len(codes), codes.shape[1] - WIDTH + 1
        h = np.zeros((n, places, FILTERS), dtype=np.float32)
        for k in range(WIDTH):
            h += self.table[k][codes[:, k : k + places]]
        won = h.argmax(axis=1)
        top = np.take_along_axis(h, won[:, None], axis=1)[:, 0]
        pooled = np.maximum(top, 0)
        hidden = np.maximum(pooled @ self.w1 + self.b1, 0)
        chance = 1 / (1 + np.exp(-np.clip(hidden @ self.w2 + self.b2, -30, 30)))
        return won, pooled, hidden, chance

    def scores(self, codes: np.ndarray, which: np.ndarray, n: int) -> np.ndarray:
        """Chance per candidate and kind: the best of its pieces."""
        out = np.zeros((n, len(KINDS)), dtype=np.float32)
        for a in range(0, len(codes), 256):
            np.maximum.at(out, which[a : a + 256], self.forward(codes[a : a + 256])[3])
        return out

    def step(self, codes, y, weight):
        won, pooled, hidden, chance = self.forward(codes)
        d = ((chance - y) * weight / len(y)).astype(np.float32)
        dh = (d @ self.w2.T) * (hidden > 0)
        dp = (dh @ self.w1.T) * (pooled > 0)
        table = np.zeros_like(self.table)
        columns = np.broadcast_to(np.arange(FILTERS), won.shape).ravel()
        for k in range(WIDTH):
            code = np.take_along_axis(codes, won + k, axis=1).ravel()
            table[k] = np.bincount(code * FILTERS + columns, weights=dp.ravel(), minlength=513 * FILTERS).reshape(513, FILTERS)
        return {"table": table, "w1": pooled.T @ dh, "b1": dh.sum(axis=0), "w2": hidden.T @ d, "b2": d.sum(axis=0)}


def fit(codes: np.ndarray, y: np.ndarray, steps: int = 600) -> Net:
    """At least ``steps`` steps of Adam over rows in random order, eight rounds for many rows."""
    net, rng = Net(), np.random.default_rng(3)
    moments = {n: (np.zeros_like(getattr(net, n)), np.zeros_like(getattr(net, n))) for n in net.names}
    steps = max(steps, 8 * len(y) // 64)
    order = np.concatenate([rng.permutation(len(y)) for _ in range(-(-steps * 64 // len(y)))])
    for step in range(1, steps + 1):
        rows = order[(step - 1) * 64 : step * 64]
        grads = net.step(codes[rows], y[rows], 1.0)
        for n in net.names:
            m, v = moments[n]
            m += 0.1 * (grads[n] - m)
            v += 0.01 * (grads[n] ** 2 - v)
            value = getattr(net, n)
            value -= 0.005 * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return net


def labelled(buf: np.ndarray, offsets: np.ndarray, base: list[list[Span]], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each candidate and kind: does a base span of the kind cover it, or lie in it?"""
    y = np.zeros((len(start), len(KINDS)), dtype=np.float32)
    for c, (s, e, d) in enumerate(zip(start.tolist(), end.tolist(), A.owners(start, offsets).tolist())):
        for a, k, b in base[d]:
            if a < e and s < b:
                y[c, k] = 1
    return y


def _labelled_candidates(batches):
    """Map function: every candidate with its context, the kinds that rules confirm (bits) and a hash of it."""
    for batch in A.chunks(batches):
        buf, offsets = A.text_bytes(batch.column("text"))
        start, end = candidates(buf, offsets)
        if not len(start):
            continue
        y = labelled(buf, offsets, base_spans(buf, buf.tobytes(), offsets), start, end)
        doc = A.owners(start, offsets)
        low, high = np.maximum(start - CONTEXT, offsets[doc]), np.minimum(end + CONTEXT, offsets[doc + 1])
        place = A.mix(((start - low) << 40 | (end - start)).astype(np.uint64))
        h = A.mix(A.range_hashes(A.prefix_hashes(buf), low, high) ^ place)
        bounds = np.concatenate(([0], np.cumsum(high - low)))
        code = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(low), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(buf[A.within(low, high - low)])]
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array((y @ (1 << np.arange(len(KINDS)))).astype(np.int32)),
                pa.array(h.view(np.int64)),
                pa.array(start - low),
                pa.array(end - start),
                code.cast(pa.binary()),
            ],
            names=["y", "h", "lead", "n", "code"],
        )


def _rows(code: pa.Array, lead: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``pieces`` of candidates that are kept with their context only."""
    buf, offsets = A.text_bytes(code)
    start = offsets[:-1] + lead
    return pieces(buf, offsets, start, start + n)


def _net(weights: dict) -> Net:
    net = Net()
    for name, value in weights.items():
        setattr(net, name, value)
    return net


def _score_counts(weights):
    """Map function: per kind, candidates by place on GRID, findings of the kind and those of no kind."""

    def run(batches):
        net = _net(weights.value)
        counts = np.zeros((len(KINDS), 2, len(GRID) + 1), dtype=np.int64)
        for batch in A.chunks(batches, "code"):
            y, lead, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "lead", "n"))
            for a in range(0, batch.num_rows, 2048):
                own = y[a : a + 2048]
                codes, which = _rows(batch.column("code").slice(a, 2048), lead[a : a + 2048], n[a : a + 2048])
                place = np.searchsorted(GRID, net.scores(codes, which, len(own)), side="right")
                for k in range(len(KINDS)):
                    counts[k, 1] += np.bincount(place[own >> k & 1 == 1, k], minlength=len(GRID) + 1)
                    counts[k, 0] += np.bincount(place[own == 0, k], minlength=len(GRID) + 1)
        k, yes, place = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (k, yes, place, counts[k, yes, place])], names=["k", "yes", "place", "m"])

    return run


def threshold(yes: np.ndarray, no: np.ndarray) -> float:
    """The largest value of GRID that finds RECALL of the findings, or 2 if it or they do not suffice.

    ``yes`` and ``no`` count findings and others by place: how many values of GRID they reach.
    """
    if yes.sum() < LEAST_HELD or not no.sum():
        return 2.0
    # Reached by all of place p + 1 and above: GRID[p].
    reach = yes[::-1].cumsum()[::-1][1:]
    enough = np.flatnonzero(reach >= RECALL * yes.sum())
    if not len(enough) or no[enough[-1] + 1 :].sum() > FALSE_SHARE * no.sum():
        return 2.0
    return float(GRID[enough[-1]])


def train(documents: DataFrame) -> tuple[dict, np.ndarray]:
    """Network and a threshold per kind (above 1: the kind adds nothing)."""
    schema_ = "y int, h long, lead long, n long, code binary"
    found = map_arrow(documents.select("text"), _labelled_candidates, schema_)
    # Copies count once: what a copied page repeats teaches and proves nothing more.
    found = hand_off(found.dropDuplicates(["y", "h"]), "candidates")
    teaches = (F.pmod("h", F.lit(HELD)) != 0) & (F.octet_length("code") <= FIT_BYTES)
    sizes = {r["y"]: r["m"] for r in found.where(teaches).groupBy("y").agg(F.count("*").alias("m")).collect()}
    never = np.full(len(KINDS), 2.0)
    if sum(sizes.values()) < 4 or set(sizes) == {0}:
        return {n: getattr(Net(), n) for n in Net.names}, never
    # Hashes are even: so large a part of their range holds each set's number, and some to spare.
    unit = F.pmod(F.xxhash64("h"), F.lit(1 << 30))
    most = {y: FIT_EACH if y else FIT_OTHERS for y in sizes}
    near = F.lit(False)
    for y, m in sizes.items():
        near |= (F.col("y") == y) & (unit < int(min(1.0, 1.5 * most[y] / m) * (1 << 30)))
    chosen = found.where(teaches & near).withColumn("u", unit).collect()
    taken: dict[int, int] = {}
    rows = []
    for r in sorted(chosen, key=lambda r: (r["u"], r["h"])):
        if taken.setdefault(r["y"], 0) < most[r["y"]]:
            taken[r["y"]] += 1
            rows.append(r)
    codes, which = _rows(pa.array([bytes(r["code"]) for r in rows]), np.array([r["lead"] for r in rows]), np.array([r["n"] for r in rows]))
    y = np.array([[r["y"] >> k & 1 for k in range(len(KINDS))] for r in rows], dtype=np.float32)
    net = fit(codes, y[which])
    weights = {n: getattr(net, n) for n in net.names}

    learned = documents.sparkSession.createDataFrame([(r["y"], r["h"]) for r in rows], "y int, h long")
    rest = found.join(F.broadcast(learned), ["y", "h"], "left_anti")
    shared = documents.sparkSession.sparkContext.broadcast(weights)
    counted = map_arrow(rest, _score_counts(shared), "k long, yes long, place long, m long").groupBy("k", "yes", "place").agg(F.sum("m").alias("m"))
    counts = np.zeros((len(KINDS), 2, len(GRID) + 1), dtype=np.int64)
    for r in counted.collect():
        counts[r["k"], r["yes"], r["place"]] = r["m"]
    return weights, np.array([threshold(counts[k, 1], counts[k, 0]) for k in range(len(KINDS))])


def scan(documents: DataFrame, model: tuple[dict, np.ndarray] | None = None) -> DataFrame:
    """The rows without ``text``, with n_assign, n_access, n_hex, base_sha256 and spans."""
    shared = documents.sparkSession.sparkContext.broadcast(model if model is not None else train(documents))

    def added(buf, data, offsets, base):
        weights, limits = shared.value
        out: list[list[Span]] = [[] for _ in base]
        if limits.min() > 1:
            return out
        start, end = candidates(buf, offsets)
        net = _net(weights)
        for a in range(0, len(start), 2048):
            s, e = start[a : a + 2048], end[a : a + 2048]
            codes, which = pieces(buf, offsets, s, e)
            chance = net.scores(codes, which, len(s))
            over = chance - limits
            for c in np.flatnonzero(over.max(axis=1) >= 0).tolist():
                d = int(A.owners(s[c : c + 1], offsets)[0])
                out[d].append((int(s[c]), int(over[c].argmax()), int(e[c])))
        return out

    return map_arrow(documents, finder(KINDS, base_spans, added), extended(documents, schema(KINDS), ("text",)))


def redact(documents: DataFrame, model: tuple[dict, np.ndarray] | None = None, mark: str = "[SECRET]") -> DataFrame:
    """The documents, columns as they are, with every found span of ``text`` replaced by ``mark``."""
    others = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    found = scan(documents.select(others.alias("row"), "text"), model)
    whole = F.col("row.text")
    parts = F.transform(
        F.split("spans", ","),
        lambda s: F.struct(F.split(s, ":")[1].cast("int").alias("a"), F.split(s, ":")[2].cast("int").alias("b")),
    )
    # Spans come by start and may overlap: a mark stands for each stretch that they cover together.
    left = F.aggregate(
        parts,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("end")),
        lambda acc, s: F.struct(
            F.when(
                (s["a"] > acc["end"]) | (acc["end"] == 0),
                F.concat(acc["out"], F.substring(whole, acc["end"] + 1, s["a"] - acc["end"]), F.lit(mark)),
            ).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["end"], s["b"]).alias("end"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(whole, acc["end"] + 1, F.length(whole))),
    )
    text = F.when(F.col("spans") == "", whole).otherwise(left)
    return found.select(*[text.alias("text") if c == "text" else F.col(f"row.`{c}`") for c in documents.columns])


def op5_secrets(documents: DataFrame) -> DataFrame:
    docs = documents.select("doc_id", "text")
    return scan(docs).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
