"""Personal data: rules, and a skip-chain conditional random field over each document.

The rules find e-mail addresses, IP addresses, card and phone numbers. The field has one node
for every word that holds a digit, an at-sign or a plus, and for the words beside it; all other
words are certainly not personal data here. Labels are "none" and the four kinds. Neighbours in
the text share a chain potential. Distant words of a document share a skip potential when they
repeat each other or have one shape (each is tied to the next such word, so the ties stay
linear in the document); loopy message passing then makes their labels agree. Word potentials
are a log-linear model over hashed shape features and pair potentials are smoothed log ratios,
fitted piece by piece on a bounded sample of texts whose rule findings are the labels; rule
look-alikes that fail a check (Luhn, parts over 255) are fitted as "none". Words whose belief
in one kind reaches ``SURE`` and that touch no base span are added, neighbours of one kind as
one span.

Defined cases: a NULL or empty text has no spans; rows are independent, so repeated rows get
the same answer; other columns are ignored; with nothing to learn from only the rules speak.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import arrays as A
from shelfwise.llm.common import extended, map_arrow, sample_texts, ship
from shelfwise.llm.spans import Span, finder, schema

KINDS = ["email", "ip", "card", "phone"]
LABELS = 1 + len(KINDS)
#: Texts to learn from, at most, those that come first by hash.
FIT_TEXTS = 4_000
BUCKETS = 1 << 13
SWEEPS, DAMPING, SURE = 8, 0.5, 0.95
#: Features of a word.
FEATURES = 9

_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(rb"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")


def _mask(signs: bytes, *ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(signs)] = True
    for a, b in ranges:
        out[a : b + 1] = True
    return out


_LOCAL = _mask(b"._%+-", (48, 57), (65, 90), (97, 122))
_DOTTED = _mask(b".", (48, 57))
_DIGITS = _mask(b"", (48, 57))
_CARDS = _mask(b" -", (48, 57))
_BLANK = _mask(b"\t\n\x0b\x0c\r ")
_MARK = _mask(b"@+", (48, 57))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _small(part: bytes) -> bool:
    part = part.lstrip(b"0")
    return len(part) <= 3 and int(part or b"0") <= 255


def base_spans(buf: np.ndarray, data: bytes, offsets: np.ndarray) -> list[list[Span]]:
    """Rule matches per document, leftmost and non-overlapping for each kind."""
    found: list[list[Span]] = [[] for _ in range(len(offsets) - 1)]
    signs = np.flatnonzero(buf == 64)
    if len(signs):
        start, end = A.runs(_LOCAL[buf], offsets)
        before = np.searchsorted(end, signs)  # a run of local characters that ends at the sign
        owner, last = A.owners(signs, offsets), -1
        for at, k, d in zip(signs.tolist(), before.tolist(), owner.tolist()):
            if k >= len(end) or end[k] != at:
                continue
            begin = max(int(start[k]), last)
            if begin >= at or begin < offsets[d]:
                continue
            m = _DOMAIN.match(data, at + 1, int(offsets[d + 1]))
            if m:
                found[d].append((begin, 0, m.end()))
                last = m.end()
    start, end = A.runs(_DOTTED[buf], offsets)
    dots = np.concatenate(([0], np.cumsum(buf == 46)))
    some = np.flatnonzero((end - start >= 7) & (dots[end] - dots[start] >= 3))
    for s, e, d in zip(start[some].tolist(), end[some].tolist(), A.owners(start[some], offsets).tolist()):
        for m in _IP.finditer(data[s:e]):  # a slice: the look-behind must not see the text before
            if all(map(_small, m[0].split(b"."))):
                found[d].append((s + m.start(), 1, s + m.end()))
    start, end = A.runs(_CARDS[buf], offsets)
    digits = np.concatenate(([0], np.cumsum(_DIGITS[buf])))
    some = np.flatnonzero(digits[end] - digits[start] >= 14)
    for s, e, d in zip(start[some].tolist(), end[some].tolist(), A.owners(start[some], offsets).tolist()):
        for m in _CARD.finditer(data, s, e):
            number = m[0].decode().replace(" ", "").replace("-", "")
            if 14 <= len(number) <= 19 and luhn(number):
                found[d].append((m.start(), 2, m.end()))
    plus = np.flatnonzero(buf == 43)
    for at, d in zip(plus.tolist(), A.owners(plus, offsets).tolist()):
        m = _PHONE.match(data, at, int(offsets[d + 1]))
        if m and 10 <= digits[m.end()] - digits[at] <= 15:
            found[d].append((at, 3, m.end()))
    return found


def _shape(word: bytes) -> bytes:
    out = re.sub(rb"[0-9]", b"9", re.sub(rb"[A-Za-z\x80-\xff]+", b"a", word))
    return out if len(out) <= 40 else out[:20] + b"~" + out[-20:]


def _features(word: bytes, left: bytes, right: bytes) -> list[int]:
    """Hashed features of a word and of the shapes beside it."""
    core = word.strip(b".,;:!?()[]{}<>\"'|")
    shape = _shape(core)
    digits = re.sub(rb"[^0-9]", b"", core)
    parts = core.split(b".")
    checks = (
        b"luhn" if 14 <= len(digits) <= 19 and luhn(digits.decode()) else b"-",
        b"parts" if len(parts) == 4 and all(p.isdigit() and _small(p) for p in parts) else b"-",
        b"at" if 0 < core.find(b"@") < len(core) - 1 and b"." in core.split(b"@")[-1].strip(b".") else b"-",
    )
    names = [
        b"s" + shape,
        b"c" + re.sub(rb"9+", b"9", shape),
        b"d%d" % min(len(digits), 20),
        b"n%d" % core.count(b"."),
        b"f" + core[:1].translate(bytes(57 if 48 <= b < 58 else 97 if 65 <= (b & 223) < 91 else b for b in range(256))),
        b"k" + b",".join(checks),
        b"l" + re.sub(rb"9+", b"9", _shape(left))[:12],
        b"r" + re.sub(rb"9+", b"9", _shape(right))[:12],
        b"bias",
    ]
    return [zlib.crc32(n) % BUCKETS for n in names]


class Graph:
    """Nodes, chain ties and skip ties of a chunk of documents."""

    def __init__(self, buf: np.ndarray, data: bytes, offsets: np.ndarray):
        start, end = A.runs(~_BLANK[buf], offsets)
        marks = np.concatenate(([0], np.cumsum(_MARK[buf])))
        core = np.flatnonzero(marks[end] > marks[start])
        owner = A.owners(start, offsets)
        near = np.unique(np.concatenate((core - 1, core, core + 1)))
        near = near[(near >= 0) & (near < len(start))]
        is_core = np.zeros(len(start), dtype=bool)
        is_core[core] = True
        # A neighbour must stand in the same document as the marked word beside it.
        same_left = np.concatenate(([False], owner[1:] == owner[:-1]))
        beside = np.zeros(len(start), dtype=bool)
        beside[1:] |= is_core[:-1] & same_left[1:]
        beside[:-1] |= is_core[1:] & same_left[1:]
        near = near[is_core[near] | beside[near]]
        self.start, self.end, self.owner, self.core = start[near], end[near], owner[near], is_core[near]
        words = [data[s:e] for s, e in zip(self.start.tolist(), self.end.tolist())]
        self.chain = np.flatnonzero((near[1:] == near[:-1] + 1) & (self.owner[1:] == self.owner[:-1]))
        linked = np.zeros(len(near) + 1, dtype=bool)
        linked[self.chain + 1] = True
        none = b""
        self.features = np.array(
            [
                _features(w, words[k - 1] if linked[k] else none, words[k + 1] if linked[k + 1] else none)
                for k, w in enumerate(words)
            ],
            dtype=np.int64,
        ).reshape(len(words), FEATURES)
        ties, seen = [], {}
        for k in np.flatnonzero(self.core).tolist():
            word = words[k].strip(b".,;:!?()[]{}<>\"'|").lower()
            for form in ((self.owner[k], 0, word), (self.owner[k], 1, _shape(word))):
                if form in seen and seen[form] not in (k, k - 1):
                    ties.append((seen[form], k))
                seen[form] = k
        self.skip = np.array(sorted(set(ties)), dtype=np.int64).reshape(-1, 2)

    def labels(self, base: list[list[Span]]) -> np.ndarray:
        out = np.zeros(len(self.start), dtype=np.int64)
        for k, (s, e, d) in enumerate(zip(self.start.tolist(), self.end.tolist(), self.owner.tolist())):
            for a, kind, b in base[d]:
                if a < e and s < b:
                    out[k] = 1 + kind
        return out


def _ratio(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smoothed log ratio of seeing two labels together to seeing them apart."""
    joint = np.full((LABELS, LABELS), 0.1)
    np.add.at(joint, (left, right), 1)
    joint /= joint.sum()
    return np.clip(np.log(joint / np.outer(joint.sum(axis=1), joint.sum(axis=0))), -3, 3)


def _fit_words(features: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Log-linear word potentials by averaged gradient steps (AdaGrad)."""
    weights, squares = np.zeros((BUCKETS, LABELS)), np.full((BUCKETS, LABELS), 1e-6)
    rng = np.random.default_rng(2)
    for _ in range(12):
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // 64)):
            f = features[rows]
            z = weights[f].sum(axis=1)
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            grad = np.zeros_like(weights)
            np.add.at(grad, f.ravel(), np.repeat(p / len(rows), f.shape[1], axis=0))
            grad += 1e-5 * weights
            squares += grad**2
            weights -= 0.3 * grad / np.sqrt(squares)
    return weights


def beliefs(graph: Graph, weights: np.ndarray, chain: np.ndarray, skip: np.ndarray) -> np.ndarray:
    """Label chances per node after loopy sum-product message passing."""
    unary = weights[graph.features].sum(axis=1)
    unary -= np.logaddexp.reduce(unary, axis=1, keepdims=True)
    source = np.concatenate((graph.chain, graph.chain + 1, graph.skip[:, 0], graph.skip[:, 1]))
    target = np.concatenate((graph.chain + 1, graph.chain, graph.skip[:, 1], graph.skip[:, 0]))
    a, b = len(graph.chain), len(graph.skip)
    back = np.concatenate((np.arange(a, 2 * a), np.arange(a), 2 * a + np.arange(b, 2 * b), 2 * a + np.arange(b)))
    pair = np.concatenate(
        [np.broadcast_to(m, (n, LABELS, LABELS)) for m, n in ((chain, a), (chain.T, a), (skip, b), (skip.T, b))]
    )
    message = np.zeros((len(source), LABELS))
    total = unary.copy()
    for _ in range(SWEEPS if len(source) else 0):
        out = np.logaddexp.reduce((total[source] - message[back])[:, :, None] + pair, axis=1)
        out -= np.logaddexp.reduce(out, axis=1, keepdims=True)
        message = DAMPING * message + (1 - DAMPING) * out
        total = unary.copy()
        np.add.at(total, target, message)
    return np.exp(total - np.logaddexp.reduce(total, axis=1, keepdims=True))


def train(documents: DataFrame) -> tuple | None:
    """Word, chain and skip potentials of fixed size, or None with nothing to learn from."""
    ship(documents.sparkSession)
    texts = [t.encode() for t in sample_texts(documents.where(F.col("text").rlike("[@+0-9]")), FIT_TEXTS)]
    if not texts:
        return None
    parts: list = []
    for a in range(0, len(texts), 200):
        data = b"".join(texts[a : a + 200])
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts[a : a + 200]])))
        buf = np.frombuffer(data, dtype=np.uint8)
        graph = Graph(buf, data, offsets)
        y = graph.labels(base_spans(buf, data, offsets))
        parts.append((graph.features, y, y[graph.chain], y[graph.chain + 1], y[graph.skip[:, 0]], y[graph.skip[:, 1]]))
    features, y, *ends = (np.concatenate([p[k] for p in parts]) for k in range(6))
    if not y.any():
        return None
    return _fit_words(features, y), _ratio(ends[0], ends[1]), _ratio(ends[2], ends[3])


def scan(documents: DataFrame, model: tuple | None = None) -> DataFrame:
    """The rows without ``text``, with a count per kind, base_sha256 and spans."""
    shared = documents.sparkSession.sparkContext.broadcast(model if model is not None else train(documents))

    def added(buf, data, offsets, base):
        out: list[list[Span]] = [[] for _ in base]
        if shared.value is None:
            return out
        graph = Graph(buf, data, offsets)
        if not len(graph.start):
            return out
        chance = beliefs(graph, *shared.value)
        kind = np.where(graph.core & (chance.max(axis=1) >= SURE), chance.argmax(axis=1), 0)
        covered = graph.labels(base) > 0
        joined = set((graph.chain + 1).tolist())
        for k in np.flatnonzero((kind > 0) & ~covered).tolist():
            word = data[graph.start[k] : graph.end[k]]
            s = int(graph.start[k]) + len(word) - len(word.lstrip(b".,;:!?()[]{}<>\"'|"))
            e = int(graph.end[k]) - len(word) + len(word.rstrip(b".,;:!?()[]{}<>\"'|"))
            own = out[graph.owner[k]]
            if s >= e:
                continue
            if own and k in joined and own[-1][1] == kind[k] - 1 and own[-1][2] >= graph.start[k - 1]:
                own[-1] = (own[-1][0], own[-1][1], e)
            else:
                own.append((s, int(kind[k]) - 1, e))
        return out

    return map_arrow(documents, finder(KINDS, base_spans, added), extended(documents, schema(KINDS), ("text",)))


def op9_pii(documents: DataFrame) -> DataFrame:
    return scan(documents.select("doc_id", "text"))
