"""Benchmark decontamination by winnowing.

Words are runs of letters and digits of the lower-cased text. Both sides keep, in every
sliding window of word k-grams, the one with the least hash. A shared span of ``span`` words
holds the same k-grams on both sides, so it keeps the same fingerprint on both: no shared span
is missed. Fingerprint hits are extended to whole spans and compared as text, so no hash
collision gets through.

The test side is cut into spans, one row per distinct span; it is joined, never collected. To
keep the training side's shuffle small, a Bloom filter of the test fingerprints (``FILTER_BITS``
bits, whatever their number) drops spans in the map tasks that cannot hit; it has no false
negatives, so a crowded filter costs time but no result.

Defined cases: a NULL or wordless text has no words, is never hit and contains nothing; an item
of fewer than ``span`` words, but not none, is one span; NULL item ids are left out; rows that
repeat an item id count once; rows that repeat a doc_id are documents of their own; other
columns of either table are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import arrays as A
from shelfwise.llm.common import hand_off, map_arrow, settled, sifted

SPAN = 10
GRAM = 4
FILTER_BITS = 1 << 23

_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, document offsets, and start and end of every word."""
    buf, offsets = A.text_bytes(column)
    buf = A.lower(buf)
    start, end = A.runs(_WORD[buf], offsets)
    return buf, offsets, start, end


def _spans(buf, start, end, span: int) -> np.ndarray:
    """First word of every run of ``span`` words inside one document, by the word bounds of each document."""
    first, last = np.searchsorted(start, buf[:-1]), np.searchsorted(start, buf[1:])
    counts = np.maximum(last - first - span + 1, 0)
    return A.within(first, counts)


def _span_texts(buf: np.ndarray, start: np.ndarray, end: np.ndarray, at: np.ndarray, n: int) -> pa.Array:
    """The words of each span, one blank between two."""
    words = A.within(at, np.full(len(at), n))
    size = end[words] - start[words] + 1
    out = np.full(int(size.sum()), 32, dtype=np.uint8)
    ends = np.cumsum(size)
    out[A.within(ends - size, size - 1)] = buf[A.within(start[words], size - 1)]
    bounds = np.concatenate(([0], ends[n - 1 :: n])).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(out)]
    ).cast(pa.binary())


def _fingerprints(hashes: np.ndarray, span: int, gram: int) -> np.ndarray:
    """Least k-gram hash of each run of ``span`` words, by its first word."""
    k = min(gram, span)
    return A.sliding_min(A.window_hashes(hashes, k), span - k + 1)


def _bits(fingerprints: np.ndarray) -> np.ndarray:
    return (fingerprints % np.uint64(FILTER_BITS)).astype(np.int64)


def _pieces(span: int, gram: int, lengths: tuple[int, ...], keep):
    """Map function: spans of each text, with those ``keep`` lets through.

    ``lengths``: span lengths below ``span`` to look for (of short items). ``keep`` takes
    fingerprints and gives a mask, or is None for the test side, where a text of fewer words
    is one span.
    """

    def run(batches):
        for batch in A.chunks(batches):
            buf, offsets, start, end = words_of(batch.column("text"))
            hashes = A.range_hashes(A.prefix_hashes(buf), start, end)
            first = np.searchsorted(start, offsets)
            count = np.diff(first)
            at, size = [], []
            for n in (span, *lengths) if keep is not None else range(1, span + 1):
                if keep is None and n < span:
                    rows = np.flatnonzero(count == n)
                    spans = first[rows]
                else:
                    spans = _spans(offsets, start, end, n)
                marks = _fingerprints(hashes, n, gram)[spans]
                if keep is not None:
                    hit = keep(marks)
                    spans, marks = spans[hit], marks[hit]
                at.append((spans, marks, n))
                size.append(len(spans))
            spans = np.concatenate([s for s, _, _ in at])
            owner = A.owners(start[spans], offsets)
            texts = pa.concat_arrays([_span_texts(buf, start, end, s, n) for s, _, n in at])
            n_words = np.concatenate([np.full(len(s), n) for s, _, n in at])
            order = np.argsort(owner, kind="stable")
            bounds = np.searchsorted(owner[order], np.arange(len(count) + 1)).astype(np.int32)
            hits = pa.StructArray.from_arrays(
                [
                    pa.array((spans - first[owner])[order].astype(np.int64)),
                    pa.array(n_words[order].astype(np.int64)),
                    pa.array(_bits(np.concatenate([m for _, m, _ in at]))[order]),
                    texts.take(pa.array(order)),
                ],
                names=["at", "n", "bit", "span"],
            )
            lists = pa.ListArray.from_arrays(pa.array(bounds), hits)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count.astype(np.int64)), lists], names=["id", "n_words", "hits"]
            )

    return run


_HITS = "n_words long, hits array<struct<at: long, n: long, bit: long, span: binary>>"


def test_spans(benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(item_id, n, bit, span): every distinct span of every item."""
    kind = benchmark.schema["item_id"].dataType.simpleString()
    texts = benchmark.where("item_id is not null").select("item_id", "text")
    found = map_arrow(texts, _pieces(span, gram, (), None), f"id {kind}, {_HITS}")
    return found.select("id", F.inline("hits")).select(F.col("id").alias("item_id"), "n", "bit", "span").distinct()


def contamination(documents: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (sorted texts of the item ids that it shares a span with).

    ``n_hit`` counts the words inside shared spans.
    """
    tests = hand_off(test_spans(benchmark, span, gram), "test-spans")
    # One bounded row: distinct filter positions as a bit set, and the few lengths of short items.
    bits = tests.select("bit").distinct().where("bit is not null")
    packed = (
        bits.groupBy((F.col("bit") / 64).cast("long").alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("v"))
        .collect()
    )
    table = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    for row in packed:
        table[row["w"]] = np.uint64(row["v"] & 0xFFFFFFFFFFFFFFFF)
    lengths = tuple(r["n"] for r in tests.where(F.col("n") < span).select("n").distinct().collect())
    shared = documents.sparkSession.sparkContext.broadcast(np.unpackbits(table.view(np.uint8), bitorder="little").view(bool))

    def keep(marks):
        return shared.value[_bits(marks)]

    kind = documents.schema["doc_id"].dataType.simpleString()
    found = map_arrow(
        documents.select("doc_id", "text"), _pieces(span, gram, lengths, keep), f"id {kind}, {_HITS}"
    ).select(F.monotonically_increasing_id().alias("row"), F.col("id").alias("doc_id"), "n_words", "hits")
    found = hand_off(found, "span-hits")
    hits = found.select("row", F.inline("hits"))
    known = tests.groupBy("span").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    matched = hits.join(known, "span").groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct("at", "n"))).alias("places"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    # Spans come in order of their first word; each adds the words beyond the furthest end so far.
    reach = F.aggregate(
        "places",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("long"), s["at"] + s["n"] - F.greatest(acc["end"], s["at"]))).alias("n"),
            F.greatest(acc["end"], s["at"] + s["n"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )
    return found.select("row", "doc_id", "n_words").join(matched, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce(reach, F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def without_contaminated(documents: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """The documents, columns as they are, that share no span with the benchmark.

    Rows are matched by doc_id and text hash, so of rows that share an id each counts by its text.
    """
    keyed = documents.select(F.struct("doc_id", F.xxhash64("text").alias("hash")).alias("doc_id"), "text")
    gone = settled(
        documents.sparkSession,
        lambda: contamination(keyed, benchmark, span, gram).where("n_hit > 0").select(
            F.col("doc_id.doc_id").alias("gone"), F.col("doc_id.hash").alias("hash")
        ).distinct(),
        "gone",
    )
    # Texts stay in place, but for those of ids that may be among the found ones.
    clean, doubtful = sifted(documents, [documents["doc_id"]], gone.select("gone"))
    found = doubtful["doc_id"].eqNullSafe(gone["gone"]) & (F.xxhash64(doubtful["text"]) == gone["hash"])
    return clean.unionAll(doubtful.join(gone, found, "left_anti"))


def op1_decontamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest columns of ``contamination``."""
    found = contamination(documents, benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
