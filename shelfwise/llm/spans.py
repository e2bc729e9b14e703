"""Spans of UTF-8 texts: rule matches on bytes, written out as kind:start:end in code points."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa

from shelfwise.llm import arrays as A

Span = tuple[int, int, int]  # start, kind's place in the list of kinds, end; in bytes of the chunk


def written(spans: Iterable[Span], kinds: list[str], points: np.ndarray, base: int) -> str:
    """Spans by start, then kind as listed: kind:start:end, comma-joined, end exclusive."""
    return ",".join(f"{kinds[k]}:{points[s] - base}:{points[e] - base}" for s, k, e in sorted(spans))


def apart(added: Iterable[Span], base: list[Span]) -> list[Span]:
    """Those of ``added`` that touch no byte of a base span nor of an earlier added one."""
    taken = sorted((s, e) for s, _, e in base)
    out: list[Span] = []
    for s, k, e in sorted(added):
        if all(e <= a or s >= b for a, b in taken) and (not out or s >= out[-1][2]):
            out.append((s, k, e))
    return out


def finder(kinds: list[str], base_of: Callable, added_of: Callable | None):
    """Map function over (..., text): counts per kind, digest of base spans, all spans.

    ``base_of(buf, data, offsets)`` gives the base spans of every document of a chunk;
    ``added_of(buf, data, offsets, base)`` those that the method adds.
    """

    def run(batches):
        for batch in A.chunks(batches):
            buf, offsets = A.text_bytes(batch.column("text"))
            data, points = buf.tobytes(), A.code_points(buf)
            base = base_of(buf, data, offsets)
            added = added_of(buf, data, offsets, base) if added_of else [[] for _ in base]
            counts = np.zeros((len(kinds), len(base)), dtype=np.int64)
            digests, texts = [], []
            for d, own in enumerate(base):
                for _, k, _ in own:
                    counts[k, d] += 1
                text = written(own, kinds, points, points[offsets[d]])
                digests.append(hashlib.sha256(text.encode()).hexdigest())
                more = apart(added[d], own)
                texts.append(written([*own, *more], kinds, points, points[offsets[d]]) if more else text)
            keep = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in keep), *map(pa.array, counts), pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                names=[*keep, *(f"n_{k}" for k in kinds), "base_sha256", "spans"],
            )

    return run


def schema(kinds: list[str]) -> str:
    return ", ".join([*(f"n_{k} long" for k in kinds), "base_sha256 string", "spans string"])
