"""Byte-level BPE by a sentencepiece model that is written straight from a rank file.

Every byte is one character of the model's alphabet, every vocabulary entry one piece whose
score is its negative rank, and normalisation is the identity. Merging by highest score, left
first, is then merging by lowest rank. A text is cut into pre-tokens by the public pattern
(worked out for whole chunks from four character classes); each distinct pre-token of a chunk
is encoded once. Decoding maps ids back to their bytes.

Ids travel as little-endian unsigned 32-bit integers in one binary value per document.

Defined cases: a NULL or empty text has no ids and decodes to no bytes; every byte sequence
has ids, so encoding and decoding is an exact round trip; an id outside the vocabulary is an
error when decoding; a text is never cut off; rows are independent of each other and other
columns stay untouched.
"""

from __future__ import annotations

import base64
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import arrays as A
from shelfwise.llm.common import extended, map_arrow

_LETTER, _NUMBER, _SPACE, _OTHER = 0, 1, 2, 3
#: Pre-tokens that a worker remembers; when full it starts afresh.
MEMORY = 100_000
_kept: dict = {}


def read_ranks(path: str) -> list[bytes]:
    """Vocabulary entries in rank order from a rank file (base64 entry and rank per line)."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    ranked = {int(rank): base64.b64decode(entry) for entry, rank in pairs}
    if sorted(ranked) != list(range(len(ranked))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    return [ranked[k] for k in range(len(ranked))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | str | int | float) -> bytes:
    """One protobuf field: bytes or text, whole number, or single-precision number."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    data = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def _as_characters(data: np.ndarray) -> np.ndarray:
    """UTF-8 of the characters U+0100 + byte: two bytes for each byte."""
    out = np.empty(2 * len(data), dtype=np.uint8)
    out[0::2] = 0xC4 + (data >> 6)
    out[1::2] = 0x80 + (data & 63)
    return out


def sentencepiece_model(ranked: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model; piece k + 1 is the entry of rank k, piece 0 is unknown."""
    pieces = [_field(1, _field(1, "<unk>") + _field(2, 0.0) + _field(3, 2))]
    for rank, entry in enumerate(ranked):
        piece = _as_characters(np.frombuffer(entry, dtype=np.uint8)).tobytes()
        pieces.append(_field(1, _field(1, piece) + _field(2, -float(rank)) + _field(3, 1)))
    trainer = _field(3, 2) + _field(4, len(ranked) + 1) + _field(40, 0)
    # No begin, end or padding piece (-1), as 64-bit two's complement.
    trainer += b"".join(_field(n, (1 << 64) - 1) for n in (41, 42, 43))
    normaliser = _field(1, "identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


def _classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    import regex

    table = np.full(0x110000, _OTHER, dtype=np.uint8)
    points = np.concatenate((np.arange(0xD800), np.arange(0xE000, 0x110000))).astype(np.uint32)
    text = points.astype("<u4").tobytes().decode("utf-32-le")
    for name, kind in ((r"\p{L}+", _LETTER), (r"\p{N}+", _NUMBER), (r"\p{White_Space}+", _SPACE)):
        for m in regex.finditer(name, text):
            table[points[m.start() : m.end()]] = kind
    return table


def _points(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points of the UTF-8 characters that begin at ``at``."""
    lead = buf[at].astype(np.int64)
    out = lead.copy()
    for least, extra, mask in ((0xC0, 1, 0x1F), (0xE0, 2, 0x0F), (0xF0, 3, 0x07)):
        rows = np.flatnonzero(lead >= least)
        if not len(rows):
            break
        value = lead[rows] & mask
        for k in range(1, extra + 1):
            value = value << 6 | buf[np.minimum(at[rows] + k, len(buf) - 1)] & 0x3F
        out[rows] = value
    return out


def pre_tokens(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte bounds of the pattern's matches; they tile every text.

    The pattern takes, in this order: an apostrophe with s, t, re, ve, m, ll or d; letters,
    numbers or other signs with at most one blank before; white space except its last
    character if something follows; white space.
    """
    if "classes" not in _kept:
        _kept["classes"] = _classes()
    at = np.flatnonzero((buf & 0xC0) != 0x80)
    n = len(at)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    point = _points(buf, at)
    kind = _kept["classes"][point]
    bounds = np.searchsorted(at, offsets)
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    change = edge.copy()
    change[1:n] |= kind[1:] != kind[:-1]
    change[n] = True
    run = np.flatnonzero(change)
    start, end = run[:-1], run[1:]
    spaces = kind[start] == _SPACE
    followed = ~edge[end]
    starts = np.zeros(n + 1, dtype=bool)
    blank = point == 32
    # Signs: one blank that stands before in the same text belongs to them.
    solid = start[~spaces]
    joined = (solid > 0) & blank[solid - 1] & ~edge[solid]
    starts[solid - joined] = True
    a, b, more = start[spaces], end[spaces], followed[spaces]
    starts[a[~more | (b - a > 1)]] = True
    starts[(b - 1)[more & ~blank[b - 1]]] = True
    # An apostrophe that begins a match takes a short ending with it.
    mark = solid[(point[solid] == 39) & ~joined]
    mark = mark[mark + 1 < n]
    mark = mark[~edge[mark + 1]]
    one = point[mark + 1]
    two = np.where((mark + 2 < n) & ~edge[np.minimum(mark + 2, n)], point[np.minimum(mark + 2, n - 1)], -1)
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = np.zeros(len(mark), dtype=bool)
    for pair in ("re", "ve", "ll"):
        long |= (one == ord(pair[0])) & (two == ord(pair[1]))
    taken = np.where(short, 1, np.where(long, 2, 0))
    mark, taken = mark[taken > 0], taken[taken > 0]
    starts[mark + 1] = False
    starts[mark + 1 + taken] = True
    first = np.flatnonzero(starts[:n])
    begin = at[first]
    return begin, np.concatenate((begin[1:], [len(buf)]))


def _distinct(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct byte strings among ranges, and which one each range is."""
    hashes = A.range_hashes(A.prefix_hashes(buf), start, end)
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    size = end - start
    same = len(size) == 0 or (
        np.array_equal(size, size[first][which])
        and np.array_equal(buf[A.within(start, size)], buf[A.within(start[first][which], size)])
    )
    data = buf.tobytes()
    if same:
        return [data[s:e] for s, e in zip(start[first].tolist(), end[first].tolist())], which
    known: dict[bytes, int] = {}  # two strings with one hash: tell them apart by their bytes
    which = np.array([known.setdefault(data[s:e], len(known)) for s, e in zip(start.tolist(), end.tolist())])
    return list(known), which


def _encoder(model: bytes, ranked: list[bytes]):
    """Function from byte strings to their ids (as bytes, four for each), kept for the worker's life."""
    import sentencepiece

    if _kept.get("model") != model:
        _kept.update(
            model=model,
            processor=sentencepiece.SentencePieceProcessor(model_proto=model),
            known={entry: struct.pack("<I", rank) for rank, entry in enumerate(ranked)},
        )
        _kept["memory"] = {}
    whole, processor = _kept["known"], _kept["processor"]

    def encode(pieces: list[bytes]) -> list[bytes]:
        memory = _kept["memory"]
        if len(memory) > MEMORY:
            memory = _kept["memory"] = {}
        found = [whole.get(p) for p in pieces]
        rest = []
        for k, ids in enumerate(found):
            if ids is None:
                found[k] = memory.get(pieces[k])
                if found[k] is None:
                    rest.append(k)
        texts = [_as_characters(np.frombuffer(pieces[k], dtype=np.uint8)).tobytes().decode() for k in rest]
        for k, ids in zip(rest, processor.encode(texts, num_threads=1) if texts else []):
            found[k] = (np.array(ids, dtype="<u4") - np.uint32(1)).tobytes()
            if len(pieces[k]) <= 64:
                memory[pieces[k]] = found[k]
        return found

    return encode


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    )


def _encoding(shared, column: str, ids: str):
    """Map function: the batches with the ids of a text column."""

    def run(batches):
        to_ids = _encoder(*shared.value)
        for batch in A.chunks(batches, column):
            buf, offsets = A.text_bytes(batch.column(column))
            start, end = pre_tokens(buf, offsets)
            pieces, which = _distinct(buf, start, end)
            parts = to_ids(pieces)
            sizes = np.array([len(p) // 4 for p in parts], dtype=np.int64)
            flat = np.frombuffer(b"".join(parts), dtype="<u4")
            first = np.cumsum(sizes) - sizes
            out = flat[A.within(first[which], sizes[which])] if len(which) else flat
            ends = np.concatenate(([0], np.cumsum(sizes[which]))) if len(which) else np.zeros(1, np.int64)
            bounds = ends[np.searchsorted(start, offsets)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, _binary(out.view(np.uint8), 4 * bounds).cast(pa.binary())], names=[*batch.schema.names, ids]
            )

    return run


def _decoding(entries, ids: str, data: str):
    """Map function: the batches with the bytes of a column of ids; ``entries()`` is the rank file's list."""

    def run(batches):
        ranked = entries()
        sizes = np.array([len(entry) for entry in ranked], dtype=np.int64)
        first = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(ranked), dtype=np.uint8)
        for batch in A.chunks(batches, ids):
            raw, offsets = A.text_bytes(batch.column(ids))
            number = np.frombuffer(raw.tobytes(), dtype="<u4").astype(np.int64)
            if len(number) and number.max() >= len(ranked):
                raise ValueError("a token id is outside the vocabulary")
            ends = np.concatenate(([0], np.cumsum(sizes[number])))
            out = flat[A.within(first[number], sizes[number])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, _binary(out, ends[offsets // 4]).cast(pa.binary())], names=[*batch.schema.names, data]
            )

    return run


def encode(documents: DataFrame, path: str, column: str = "text", ids: str = "ids") -> DataFrame:
    """The documents with their text's token ids in a new binary column; ``path``: the rank file."""
    ranked = read_ranks(path)
    shared = documents.sparkSession.sparkContext.broadcast((sentencepiece_model(ranked), ranked))
    return map_arrow(documents, _encoding(shared, column, ids), extended(documents, f"`{ids}` binary"), lean=True)


def decode(encoded: DataFrame, path: str, ids: str = "ids", data: str = "decoded") -> DataFrame:
    """The rows with the bytes of their token ids in a new binary column; NULL ids give no bytes."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))
    return map_arrow(encoded, _decoding(lambda: shared.value, ids, data), extended(encoded, f"`{data}` binary"), lean=True)


def round_trip(documents: DataFrame, path: str, column: str = "text", ids: str = "ids", data: str = "decoded") -> DataFrame:
    """The documents without their text, but with its token ids and what these decode to.

    The same as ``decode(encode(...))`` in one worker per task instead of two.
    """
    ranked = read_ranks(path)
    shared = documents.sparkSession.sparkContext.broadcast((sentencepiece_model(ranked), ranked))
    to_ids, to_data = _encoding(shared, column, ids), _decoding(lambda: shared.value[1], ids, data)

    def run(batches):
        def without_text():
            for batch in to_ids(batches):
                yield batch.drop_columns([column])

        return to_data(without_text())

    return map_arrow(documents, run, extended(documents, f"`{ids}` binary, `{data}` binary", (column,)), lean=True)


def op4_bpe(documents: DataFrame, path: str) -> DataFrame:
    """Digests of ids and of the decoded bytes for every whole text."""
    both = round_trip(documents.select("doc_id", "text"), path)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
