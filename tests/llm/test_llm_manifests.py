"""Manifest, shards and whitening against plain versions, on small tables with every odd case."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from shelfwise.llm import manifest, shards, whiten

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos int, node string, root string, row int, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, "n", "r", 3, 4) for r in rows], DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute_tree(nodes):
    """Root, and for every node the list of (siblings before, after) level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = nodes[i // 8 * 8 : i // 8 * 8 + 8]
            paths[k].append((run[: i % 8], run[i % 8 + 1 :]))
        nodes, at = [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)], [i // 8 for i in at]
    return nodes[0], paths


def brute_manifest(rows):
    def leaf(r, text):
        return sha("".join(field(v) for v in (r[0], r[3], r[2], r[4], text)))

    def least(v):
        return (v is not None, v)

    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r, leaf(r, r[1])))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    tops = []
    for n in names:
        trees[n].sort(key=lambda x: (least(x[0][0]), x[1]))
        tops.append(brute_tree([x[1] for x in trees[n]]))
    root, above = brute_tree([t for t, _ in tops])
    out = []
    for n, (subroot, paths), outer in zip(names, tops, above):
        for (r, own), path in zip(trees[n], paths):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            text = "".join(c.lower() if c.isascii() else c for c in r[1]) if tampered and r[1] is not None else r[1]
            node = leaf(r, text)
            for before, after in path + outer:
                node = sha("".join([*before, node, *after]))
            proof = sha("".join("".join(b + a) for b, a in path + outer))
            out.append((str(r[0]), own, subroot, root, proof, node, node == root))
    return sorted(out)


def manifest_rows(spark, rows):
    got = manifest.op11_manifest(frame(spark, rows)).collect()
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got)


@pytest.mark.parametrize("sizes", [{"en": 1100, None: 3, "de": 1, "": 9, "é": 64}, {"en": 1}, {"en": 8, "fr": 513}])
def test_manifest_equals_brute_force(spark, sizes):
    rng = random.Random(3)
    rows = []
    for lang, many in sizes.items():
        for _ in range(many):
            text = rng.choice([None, "", "Abc", "é Ä", "Z" * 5000, "plain", "MiXed %d" % rng.randint(0, 9)])
            rows.append((len(rows), text, lang, rng.choice([None, "s", "ü"]), rng.choice([None, 0, 12])))
    if len(rows) > 20:
        rows += [(None, "a", "en", "s", 1), (None, "B", "de", None, 1), rows[0], rows[0], (rows[0][0], "other", "en", "s", 1)]
    want = brute_manifest(rows)
    assert manifest_rows(spark, rows) == want
    if len(rows) > 1000:
        changed = sum(1 for r in want if not r[6])
        assert 0 < changed < len(rows) / 2


def test_manifest_of_many_trees_and_none(spark):
    rows = [(k, "x", "l%d" % k, "s", 1) for k in range(600)]
    assert manifest_rows(spark, rows) == brute_manifest(rows)
    assert manifest_rows(spark, []) == []


def test_proofs_fold_to_the_root(spark):
    told = manifest.manifest(frame(spark, [(k, "t%d" % k, "ab"[k % 2], "s", 1) for k in range(70)])).collect()
    assert all(r.verified and manifest.fold(r.leaf, r.proof, r.places) == r.root for r in told)
    assert manifest.fold(told[1].leaf, told[0].proof, told[0].places) != told[0].root


def brute_shards(rows):
    sized = []
    for r in rows:
        data = (r[1] or "").encode()
        mixed = hashlib.md5(":".join(["7"] + ([] if r[0] is None else [str(r[0])])).encode()).hexdigest()
        sized.append(("-" if r[3] is None else "=" + r[3], mixed, (r[0] is not None, r[0]), len(data) + 8, zlib.crc32(data)))
    strata = {}
    for x in sorted(sized):
        strata.setdefault(x[0], []).append(x)
    order = []
    for name, own in strata.items():
        for k, x in enumerate(own):
            phase = (int(hashlib.md5(f"7:{name}".encode()).hexdigest()[:8], 16) + 0.5) / 2**32
            order.append(((k + phase) / len(own), name, x))
    out, n = [], len(order)
    for at, (*_, x) in enumerate(sorted(order)):
        shard = at * 24 // n
        out.append((str(x[2][1]), x[3], x[4], "rows", shard, at - -(-shard * n // 24), None))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [0, 1, 23, 24, 700])
def test_shards_equal_brute_force(spark, n):
    rng = random.Random(n)
    rows = [(k, rng.choice([None, "", "é" * 9, "x" * rng.randint(1, 30_000)]), "en", rng.choice(["hot", "hot", "hot", "a", None]), 1) for k in range(n)]
    if n > 30:
        rows += [(None, "q", "en", "a", 1), rows[3], rows[3]] + [(5, "copy %d" % k, "en", "hot", 1) for k in range(40)]
    got = shards.op12_shards(frame(spark, rows)).collect()
    want = brute_shards(rows)
    assert sorted([(str(r.doc_id), r["size"], r.text_crc32, r.law, r.shard, r.slot, r.grown_shard) for r in got], key=str) == want
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_every_shard_matches_the_mixture_and_is_written_in_order(spark, tmp_path):
    rows = [(k, "x", "en", "hot" if k % 3 else "s%d" % (k % 5), 1) for k in range(2400)]
    dealt = shards.interleaved(frame(spark, rows), 24)
    for name in ["hot"] + ["s%d" % k for k in range(5)]:
        want = sum(r[3] == name for r in rows) / 24
        counts = {r.shard: r["count"] for r in dealt.where(f"row.source = '{name}'").groupBy("shard").count().collect()}
        assert all(abs(counts.get(s, 0) - want) <= 3 for s in range(24))
    shards.write_shards(dealt, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 2400 and back.where("shard = 3").select("row.doc_id").distinct().count() == 100


VECTORS = "vec_id long, embedding array<float>, key string, vector int, x binary"


def vectors(spark, rows):
    return spark.createDataFrame([(k, v, "k", 1, None) for k, v in rows], VECTORS)


def brute_whitening(rows):
    kept = [(k, np.floor(64 * np.array(v, dtype=np.float32).astype(np.float64)).astype(np.int64) + 1_000_000) for k, v in rows]
    listed = np.array(sorted({tuple(int(c) for c in x) for _, x in kept}), dtype=np.int64)
    n, s = len(listed), listed.sum(axis=0)
    centred = (n * listed - s) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return kept, n, s, values[::-1], axes[:, ::-1]


def check_whitening(spark, good, bad=()):
    got = whiten.op13_whitening(vectors(spark, [*good, *bad])).collect()
    kept, n, s, values, axes = brute_whitening(good)
    k = min(16, int((values > 1e-12 * values[0]).sum())) if values[0] > 0 else 0
    assert len(got) == k * len(good)
    by = {}
    for r in got:
        assert r.n == n and r.identity_error < 1e-9
        assert math.isclose(r.explained, values[r.component - 1] / values.sum(), rel_tol=1e-9)
        by.setdefault(str(r.vec_id), []).append(r)
    signs = {}
    for key, x in kept:
        dev = sum((n * int(c) - int(t)) ** 2 for c, t in zip(x, s))
        assert {r.deviation for r in by.get(str(key), [])} <= {dev}
        for r in by.get(str(key), []):
            want = float((x - s / n) @ axes[:, r.component - 1]) / math.sqrt(values[r.component - 1])
            if abs(want) > 1e-3:
                sign = signs.setdefault(r.component, np.sign(want) * np.sign(r.whitened))
                assert math.isclose(r.whitened * sign, want, rel_tol=1e-6, abs_tol=1e-8)


def test_whitening_equals_eigenvectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 20)) * np.linspace(1, 3, 20)
    good = [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(base)]
    good += [(1000 + k, good[7][1]) for k in range(200)] + [(3, [float(np.float32(c + 1e-4)) for c in good[3][1]])]
    bad = [(-1, None), (-2, []), (-3, [1.0] * 19 + [float("nan")]), (-4, [1.0] * 19 + [float("inf")]), (-5, [1.0] * 19 + [None]), (-6, [1.0] * 3)]
    check_whitening(spark, good, bad)


def test_whitening_without_variance(spark):
    check_whitening(spark, [(1, [0.5, 0.25])])
    check_whitening(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])
    check_whitening(spark, [(k, [k / 2, 3.0, k / 2, -700.0 * (k % 3)]) for k in range(30)])
    check_whitening(spark, [(1, [1.0, 2.0, 3.0]), (2, [4.0, 4.0, 4.0])])
    assert whiten.op13_whitening(vectors(spark, [(1, None)])).collect() == []
    assert whiten.op13_whitening(vectors(spark, [])).collect() == []


def test_far_values_are_exact(spark):
    rows = [(1, [2.0**40, 0.0]), (2, [-(2.0**20), 1.0]), (3, [-1.0 / 128, 1.0])]
    model = whiten.fit(vectors(spark, rows))
    want = [sum(math.floor(64 * r[1][d]) + 1_000_000 for r in rows) for d in range(2)]
    assert model.n == 3 and model.sums() == want
    with pytest.raises(Exception, match="63 bits"):
        whiten.op13_whitening(vectors(spark, rows)).collect()


def decomposed(r):
    a, b, p = whiten.bidiagonal(r)
    squares = whiten.squared_singular_values(a, b)
    k = int((squares > (8 * len(r) * whiten.EPS) ** 2 * squares[0]).sum())
    return squares, p @ whiten.right_vectors(a, b, squares[:k])


@pytest.mark.parametrize("case", ["plain", "equal", "graded", "repeated", "dependent", "short", "close"])
def test_small_solver(case):
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    x = {
        "plain": rng.normal(size=(200, 40)),
        "equal": np.eye(40),
        "graded": rng.normal(size=(200, 40)) * np.logspace(0, -9, 40),
        "repeated": (q * np.repeat([3.0, 2.0, 1.0, 1e-3], 10)) @ q.T,
        "dependent": rng.normal(size=(200, 40)) @ np.diag([1.0] * 35 + [0.0] * 5) @ q,
        "short": np.vstack([rng.normal(size=(5, 40)), np.zeros((35, 40))]),
        "close": (q * (1 + 1e-9 * np.arange(40))) @ q.T,
    }[case]
    r = np.linalg.qr(x, mode="r")
    squares, v = decomposed(r)
    true = np.linalg.svd(r, compute_uv=False) ** 2
    assert np.abs(squares - true).max() < 1e-13 * true[0]
    assert np.abs(v.T @ v - np.eye(v.shape[1])).max() < 1e-10
    assert np.abs(r.T @ (r @ v) - v * squares[: v.shape[1]]).max() < 1e-12 * true[0]
    if case == "plain":
        near = np.linalg.svd(r)[2].T
        assert np.abs(np.abs((near * v).sum(axis=0)) - 1).max() < 1e-12
