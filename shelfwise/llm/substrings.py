"""Removal of byte strings that an earlier document holds, one suffix bucket at a time.

A string of ``LENGTH`` bytes that starts in two documents is found without moving all suffixes.
In every ``LENGTH``-byte window the ``GRAM``-byte string with the least hash is its anchor;
equal windows have equal anchors at equal places. Two rounds follow, each dealt by anchor into
buckets whose size does not grow with the data:

1. every chunk of documents sends the hashes of its anchors, once each, and learns which of
   them stand in two documents;
2. for the shared ones it sends the text around the anchor (all windows it stands for) with the
   least doc_id of the chunk. A bucket task sorts these suffixes and sees for each window
   whether a smaller doc_id has it.

Followers within a chunk (the same text under a larger doc_id) are settled there, so a passage
in a third of all documents sends one row per chunk. Chunks are written once, bucketed by chunk
number, and joined with what the rounds found; text is never shuffled.

Defined cases: a NULL or empty text has no bytes; a text below ``LENGTH`` bytes keeps all; rows
that share a doc_id never remove from each other; rows without doc_id keep all their bytes
and remove none elsewhere; other columns are ignored. Windows are told apart by 64-bit hashes
within a bucket of one anchor hash.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import arrays as A
from shelfwise.llm.common import lean_group, map_arrow, ship
from shelfwise.session import scratch_path

LENGTH = 50
GRAM = 28
#: Text bytes for each bucket, while there are at most this many buckets; beyond, up to ROOMY.
TIGHT, MANY, ROOMY = 1 << 20, 4096, 1 << 24

#: Text bytes of a chunk (a longer document is a chunk of its own).
PACKED = 3 << 19

#: Bytes of rows that go to a worker together (rows are chunks): a few chunks, not all of a task's.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
FEW = 4 * PACKED
#: Suffixes of a bucket that are hashed together.
BLOCK = 1 << 12

_SPAN = LENGTH - GRAM  # an anchor stands at most this far into a window
_CONTEXT = _SPAN + LENGTH
_BITS = 1 << np.arange(_SPAN + 1, dtype=np.int64)


class Dealing:
    """How anchor hashes fall into buckets, and how many bytes tell them apart there."""

    def __init__(self, text_bytes: int):
        wanted = max(min(text_bytes // TIGHT, MANY), text_bytes // ROOMY, 1)
        self.bits = max(0, math.ceil(math.log2(wanted)))
        # Chance sharing of a shortened hash only costs work: seven bits over the count are plenty.
        self.bytes = min(8, max(2, math.ceil((math.log2(max(text_bytes, 2)) + 4 - self.bits) / 8)))

    def bucket(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(h), np.int64)

    def names(self, h: np.ndarray) -> np.ndarray:
        """Bucket and what is kept of the hash within it, as one number that sorts by bucket."""
        return h >> np.uint64(max(0, 64 - self.bits - 8 * self.bytes))

    def short(self, names: np.ndarray) -> bytes:
        return np.ascontiguousarray(names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : self.bytes]).tobytes()

    def long(self, data: bytes) -> np.ndarray:
        raw = np.frombuffer(data, dtype=np.uint8).reshape(-1, self.bytes)
        out = np.zeros((len(raw), 8), dtype=np.uint8)
        out[:, : self.bytes] = raw
        return out.view("<u8").ravel()

    def bucket_of_names(self, names: np.ndarray) -> np.ndarray:
        return (names >> np.uint64(min(63, 8 * self.bytes))).astype(np.int64) if self.bits else np.zeros(len(names), np.int64)


def pack(documents: DataFrame, buckets: int) -> DataFrame:
    """Chunks of documents (chunk, ids, known, offsets, text), stored bucketed by chunk number."""

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in A.chunks(batches, limit=PACKED):
            buf, offsets = A.text_bytes(batch.column("text"))
            ids = batch.column("doc_id")
            known = ~np.asarray(ids.is_null())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes()], pa.binary()),
                    pa.array([known.tobytes()], pa.binary()),
                    pa.array([offsets.astype("<i8").tobytes()], pa.binary()),
                    pa.array([buf.tobytes()], pa.binary()),
                ],
                names=["chunk", "ids", "known", "offsets", "text"],
            )
            number += 1

    packed = map_arrow(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        run,
        "chunk long, ids binary, known binary, offsets binary, text binary",
        lean=True,
    )
    spark = documents.sparkSession
    name = f"chunks_{uuid.uuid4().hex}"
    writer = packed.write.bucketBy(buckets, "chunk").option("compression", "zstd").option("path", scratch_path(spark, "chunks"))
    writer.saveAsTable(name)
    return spark.table(name)


def _rows(batch: pa.RecordBatch):
    """Rows one at a time: a batch holds many chunks, a task looks at one."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def _chunk(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    buf = np.frombuffer(row["text"], dtype=np.uint8)
    ids, offsets = np.frombuffer(row["ids"], dtype="<i8"), np.frombuffer(row["offsets"], dtype="<i8")
    return buf, offsets.astype(np.int64), ids, np.frombuffer(row["known"], dtype=bool)


def anchors(buf: np.ndarray, offsets: np.ndarray, known: np.ndarray):
    """(place, hash, mask) of every anchor; bit t of the mask: it stands for the window at place - _SPAN + t."""
    empty = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    n = len(buf) - LENGTH + 1
    if n <= 0:
        return empty
    h = A.gram_hashes(buf, GRAM)
    least = A.sliding_min(h, _SPAN + 1)
    room = np.where(known, np.maximum(np.diff(offsets) - LENGTH + 1, 0), 0)
    valid = np.zeros(n, dtype=bool)
    valid[A.within(offsets[:-1], room)] = True
    # Windows by their start, with _SPAN places before the first and after the last that match nothing.
    best = np.zeros(len(h) + _SPAN, dtype=np.uint64)
    best[_SPAN : _SPAN + n][valid] = least[valid]
    most = ~A.sliding_min(~best, _SPAN + 1)
    place = np.flatnonzero((most == h) & (h > 0))
    mask = np.zeros(len(place), dtype=np.int64)
    for t in range(_SPAN + 1):
        mask |= np.where(best[place + t] == h[place], _BITS[t], 0)
    return place, h[place], mask


def _slices(bucket: np.ndarray):
    """(bucket, first, end) of every stretch of one bucket in sorted numbers."""
    cut = np.flatnonzero(np.diff(bucket)) + 1
    for a, b in zip(np.concatenate(([0], cut)), np.concatenate((cut, [len(bucket)]))):
        if b > a:
            yield int(bucket[a]), int(a), int(b)


def _name_table(names: np.ndarray, owner: np.ndarray):
    """Distinct names, whether each stands in two documents of the chunk, and which one each anchor has."""
    distinct, which = np.unique(names, return_inverse=True)
    first = np.full(len(distinct), np.iinfo(np.int64).max)
    last = np.full(len(distinct), -1)
    np.minimum.at(first, which, owner)
    np.maximum.at(last, which, owner)
    return distinct, first != last, which


def _send_names(dealing: Dealing):
    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                buf, offsets, _, known = _chunk(row)
                place, h, _ = anchors(buf, offsets, known)
                names, several, _ = _name_table(dealing.names(h), A.owners(place, offsets))
                out = [
                    (b, row["chunk"], dealing.short(names[x:y]), np.packbits(several[x:y]).tobytes())
                    for b, x, y in _slices(dealing.bucket_of_names(names))
                ]
                if out:
                    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["bucket", "chunk", "names", "several"]
                    )

    return run


def _shared_names(dealing: Dealing):
    """One bucket: for each chunk's names, which stand in two documents."""

    def run(group: pa.Table) -> pa.Table:
        parts = [dealing.long(v) for v in group.column("names").to_pylist()]
        sizes = np.array([len(p) for p in parts])
        several = np.concatenate(
            [np.unpackbits(np.frombuffer(v, np.uint8), count=n) for v, n in zip(group.column("several").to_pylist(), sizes)]
        )
        _, which, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        shared = counts[which] > 1
        shared |= np.bincount(which, weights=several)[which] > 0
        ends = np.cumsum(sizes)
        bits = [np.packbits(shared[e - n : e]).tobytes() for e, n in zip(ends, sizes)]
        return pa.table({"chunk": group.column("chunk"), "bucket": group.column("bucket"), "data": pa.array(bits, pa.binary())})

    return run


def _contexts(buf: np.ndarray, place: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The text around each anchor; bytes outside its windows are zero: equal contexts compress and compare alike."""
    around = (place - _SPAN)[:, None] + np.arange(_CONTEXT)
    inside = (around >= start[:, None]) & (around < end[:, None])
    return np.where(inside, buf[np.clip(around, 0, len(buf) - 1)], np.uint8(0))


def _send_windows(dealing: Dealing):
    """For every shared anchor the text around it; what a smaller doc_id of the chunk settles goes without text."""

    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                buf, offsets, ids, known = _chunk(row)
                place, h, mask = anchors(buf, offsets, known)
                names, _, which = _name_table(dealing.names(h), A.owners(place, offsets))
                shared = np.zeros(len(names), dtype=bool)
                answers = {r["bucket"]: r["data"] for r in row["found"] or []}
                for b, x, y in _slices(dealing.bucket_of_names(names)):
                    shared[x:y] = np.unpackbits(np.frombuffer(answers[b], np.uint8), count=y - x)
                keep = np.flatnonzero(shared[which])
                place, h, mask = place[keep], h[keep], mask[keep]
                if not len(place):
                    continue
                doc = ids[A.owners(place, offsets)]
                low = np.log2(mask & -mask).astype(np.int64)
                high = np.log2(mask).astype(np.int64)
                start, end = place - _SPAN + low, place - _SPAN + high + LENGTH
                text = A.range_hashes(A.prefix_hashes(buf), start, end) ^ A.mix(mask.astype(np.uint64))
                _, same = np.unique(text, return_inverse=True)
                least = np.full(same.max() + 1, np.iinfo(np.int64).max)
                np.minimum.at(least, same, doc)
                leads = doc == least[same]
                order = np.argsort(dealing.bucket(h), kind="stable")
                out = []
                for b, x, y in _slices(dealing.bucket(h)[order]):
                    own = order[x:y]
                    lead, rest = own[leads[own]], own[~leads[own]]
                    context = _contexts(buf, place[lead], start[lead], end[lead])
                    out.append(
                        (
                            b,
                            row["chunk"],
                            place[lead].astype("<u4").tobytes(),
                            mask[lead].astype("<u4").tobytes(),
                            doc[lead].astype("<i8").tobytes(),
                            context.tobytes(),
                            place[rest].astype("<u4").tobytes(),
                            mask[rest].astype("<u4").tobytes(),
                        )
                    )
                kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 6)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                    names=["bucket", "chunk", "place", "mask", "doc", "context", "done_place", "done_mask"],
                )

    return run


def _windows(mask: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, place, hash) of every window that the contexts hold."""
    parts = []
    for a in range(0, max(len(mask), 1), BLOCK):
        row, t = np.nonzero((mask[a : a + BLOCK, None] & _BITS) > 0)
        start = row * _CONTEXT + t
        sums = A.prefix_hashes(context[a * _CONTEXT : (a + BLOCK) * _CONTEXT])
        parts.append(((row + a).astype(np.int32), t.astype(np.int8), A.range_hashes(sums, start, start + LENGTH)))
    return tuple(np.concatenate([p[k] for p in parts]) for k in range(3))


def _earlier_windows(group: pa.Table) -> pa.Table:
    """One bucket of suffixes: which windows of each occurrence a smaller doc_id has."""

    def joined(name: str, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join(group.column(name).to_pylist()), dtype=kind)

    sizes = np.array([len(v) // 4 for v in group.column("place").to_pylist()])
    mask, doc = joined("mask", "<u4").astype(np.int64), joined("doc", "<i8")
    context = joined("context", "u1")
    row, t, window = _windows(mask, context)
    order = np.lexsort((doc[row], window))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = window[order][1:] != window[order][:-1]
    least = doc[row[order]][np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    late = np.zeros(len(order), dtype=bool)
    late[order] = doc[row[order]] > least
    gone = np.bincount(row[late], weights=_BITS[t[late]], minlength=len(mask)).astype("<u4")
    ends = np.cumsum(sizes)
    places = joined("place", "<u4")
    out_place, out_mask = [], []
    for e, n, a, b in zip(ends, sizes, group.column("done_place").to_pylist(), group.column("done_mask").to_pylist()):
        hit = np.flatnonzero(gone[e - n : e]) + e - n
        out_place.append(places[hit].tobytes() + a)
        out_mask.append(gone[hit].tobytes() + b)
    return pa.table({"chunk": group.column("chunk"), "place": pa.array(out_place, pa.binary()), "mask": pa.array(out_mask, pa.binary())})


def _removed(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, offsets, ids, known and which bytes go, from the windows that were found."""
    buf, offsets, ids, known = _chunk(row)
    change = np.zeros(len(buf) + LENGTH + 1, dtype=np.int32)
    for found in row["found"] or []:
        place = np.frombuffer(found["place"], dtype="<u4").astype(np.int64)
        mask = np.frombuffer(found["mask"], dtype="<u4").astype(np.int64)
        one, t = np.nonzero((mask[:, None] & _BITS) > 0)
        start = place[one] - _SPAN + t
        np.add.at(change, start, 1)
        np.add.at(change, start + LENGTH, -1)
    return buf, offsets, ids, known, np.cumsum(change)[: len(buf)] > 0


def _kept(texts: bool):
    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                buf, offsets, ids, known, gone = _removed(row)
                total = np.concatenate(([0], np.cumsum(gone)))
                start, _ = A.runs(gone, offsets)
                spans = np.bincount(A.owners(start, offsets), minlength=len(ids)) if len(start) else np.zeros(len(ids), np.int64)
                left = buf[~gone].tobytes()
                ends = offsets - total[offsets]
                parts = [left[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                kept = pa.array(parts, pa.binary()) if texts else pa.array([hashlib.sha256(p).hexdigest() for p in parts])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64(), mask=~known),
                        pa.array(np.diff(offsets)),
                        pa.array(np.diff(total[offsets])),
                        pa.array(spans.astype(np.int64)),
                        kept,
                    ],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return run


def remove_repeats(documents: DataFrame, texts: bool = True) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans and ``kept``.

    ``kept`` is what remains as bytes (a cut may fall inside a character), or its SHA-256 in
    hexadecimal with ``texts=False``.
    """
    spark = documents.sparkSession
    ship(spark)
    if spark.conf.get(BATCH_BYTES) == "67108864b":  # unless the session asks for another size
        spark.conf.set(BATCH_BYTES, f"{FEW}b")
    total = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealing = Dealing(total)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)
    chunks = pack(documents, buckets)

    def gathered(found: DataFrame, *columns: str) -> DataFrame:
        return found.groupBy("chunk").agg(F.collect_list(F.struct(*columns)).alias("found"))

    def with_text(found: DataFrame) -> DataFrame:
        return chunks.join(found.hint("shuffle_hash"), "chunk", "left")

    names = map_arrow(chunks, _send_names(dealing), "bucket long, chunk long, names binary, several binary", lean=True)
    shared = names.groupBy("bucket").applyInArrow(lean_group(_shared_names(dealing)), "chunk long, bucket long, data binary")
    sent = map_arrow(
        with_text(gathered(shared, "bucket", "data")),
        _send_windows(dealing),
        "bucket long, chunk long, place binary, mask binary, doc binary, context binary, done_place binary, done_mask binary",
        lean=True,
    )
    late = sent.groupBy("bucket").applyInArrow(lean_group(_earlier_windows), "chunk long, place binary, mask binary")
    run: Callable = _kept(texts)
    kind = "binary" if texts else "string"
    schema = f"doc_id long, n_bytes long, n_removed long, n_spans long, kept {kind}"
    return map_arrow(with_text(gathered(late, "place", "mask")), run, schema, lean=True)


def op10_repeats(documents: DataFrame) -> DataFrame:
    return remove_repeats(documents, texts=False).withColumnRenamed("kept", "kept_sha256")
