"""PCA whitening of vectors by singular values of the centred rows, never of a covariance.

Vectors are put on a grid of 64ths (exact integers), and the fit list holds each distinct grid vector
once. Tasks reduce their centred rows block by block to a triangle R by QR; triangles meet in a tree
of small groups until one is left, as large as the dimension and not as the data. On the driver
Householder reflections turn R into a bidiagonal matrix, dqds (differential quotient
differences, shifted from below, so nothing is subtracted that was not there) finds its singular values
to high relative accuracy, and twisted factorisations of the shifted tridiagonal give the directions.
A last pass over the fit list measures the covariance of what came out.

Defined cases: rows whose vector is NULL, empty, or holds NULL or non-finite entries take no part, nor do
those of another length than most (the longer, if two lengths tie); a grid value beyond 62 bits is an error, and so is a
deviation beyond 63 bits; directions without variance (equal vectors, constant or dependent
dimensions, one vector alone) are no components; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import hand_off, map_arrow, ship

GRID, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Triangles of one group on each step of the tree, and the groups that the first step makes at most.
MEET, FIRST_GROUPS = 16, 4096
EPS = np.finfo(np.float64).eps
CLOSE = 1e-4


# Singular values and directions of one small matrix


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right basis P of a bidiagonal matrix B = Q' R P (Householder)."""
    a = r.astype(np.float64).copy()
    d = a.shape[1]
    right = np.eye(d)

    def mirror(x: np.ndarray) -> np.ndarray | None:
        """Unit normal of the reflection that leaves only the first entry of x."""
        size = np.abs(x).max(initial=0.0)
        if size == 0 or not np.any(x[1:]):
            return None
        v = x / size
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        return v / np.linalg.norm(v)

    for k in range(d):
        v = mirror(a[k:, k])
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < d - 2:
            v = mirror(a[k, k + 1 :])
            if v is not None:
                a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
                right[:, k + 1 :] -= 2 * np.outer(right[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One dqds step on squares: the new q and e, and the differences d. A negative d means too large a shift."""
    d = q[0] - shift
    out_q, out_e, all_d = [], [], [d]
    for k, link in enumerate(e):
        top = d + link
        out_q.append(top)
        ratio = q[k + 1] / top if top > 0 else 1.0
        out_e.append(link * ratio)
        d = d * ratio - shift
        all_d.append(d)
    return [*out_q, d], out_e, all_d


def _negligible(link: float, left: float, right: float, base: float) -> bool:
    """Does dropping a link change values (base + those of the block) by less than their rounding?"""
    if link <= EPS**2 * (base + min(left, right)) or link < 1e-290:
        return True
    return link <= EPS * base and link * max(left, right) <= (EPS * base) ** 2


def squared_singular_values(diagonal: np.ndarray, beside: np.ndarray) -> np.ndarray:
    """Squares of a bidiagonal matrix's singular values, falling, by dqds.

    The sum of 1/d of an unshifted step is the trace of the inverse; its reciprocal is Newton's step towards
    the least value from below. It never overshoots, so every step keeps all quantities positive,
    and those small against the shifts made so far can be dropped without harm to the others.
    """
    found: list[float] = []
    size = max(np.abs(diagonal).max(initial=0.0), np.abs(beside).max(initial=0.0))
    if size == 0:
        return np.zeros(len(diagonal))
    open_blocks = [([float(x) for x in (diagonal / size) ** 2], [float(x) for x in (beside / size) ** 2], 0.0)]
    steps = 0
    while open_blocks:
        q, e, base = open_blocks.pop()
        while q:
            steps += 1
            if steps > 200 * len(diagonal) + 1000:
                raise RuntimeError("singular values did not settle")
            cut = next((k for k in range(len(e) - 1, -1, -1) if _negligible(e[k], q[k], q[k + 1], base)), None)
            if cut is not None:
                if cut < len(e) - 1:
                    open_blocks.append((q[: cut + 1], e[:cut], base))
                    q, e = q[cut + 1 :], e[cut + 1 :]
                else:
                    found.append(base + max(q.pop(), 0.0))
                    e.pop()
                continue
            if len(q) == 1:
                found.append(base + max(q[0], 0.0))
                break
            # Small values converge at the end, so a block that grows towards its end is turned round.
            if q[0] < q[-1] * 0.5:
                q, e = _turned(q, e)
            q, e, d = _sweep(q, e, 0.0)
            if min(d) <= 0:
                continue
            shift = 1.0 / sum(1.0 / x for x in d)
            while shift > EPS * (base + min(q)):
                next_q, next_e, d = _sweep(q, e, shift)
                if min(d) >= 0:
                    q, e, base = next_q, next_e, base + shift
                    break
                shift *= 0.75
    return np.sort(np.array(found))[::-1] * size**2


def _turned(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The block read from its other end; its values are the same (B and its flipped transpose)."""
    return q[::-1], e[::-1]


def _twisted(diagonal: np.ndarray, beside: np.ndarray, value: float) -> tuple[np.ndarray, list[float], list[float]]:
    """gamma of every twist, and the factors down to it and up to it, of B'B - value."""
    n = len(diagonal)
    square, link, cross = diagonal**2, beside**2, diagonal[:-1] * beside
    tiny = EPS * max(square.max(initial=0.0), link.max(initial=0.0), 1e-300) * EPS
    s, down, p, up = [-value], [], [square[-1] - value], []
    for k in range(n - 1):
        pivot = s[-1] + square[k]
        pivot = pivot if abs(pivot) > tiny else tiny
        down.append(cross[k] / pivot)
        s.append(link[k] * s[-1] / pivot - value)
    for k in range(n - 2, -1, -1):
        pivot = link[k] + p[-1]
        pivot = pivot if abs(pivot) > tiny else tiny
        up.append(cross[k] / pivot)
        p.append(square[k] * p[-1] / pivot - value)
    return np.array(s) + np.array(p[::-1]) + value, down, up[::-1]


def right_vectors(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit right singular vectors (columns) of a bidiagonal matrix for its squared values, falling.

    Each comes from the twist with the least gamma; vectors of values closer than ``CLOSE`` of the largest are made
    orthogonal to each other, from the best further twists where one adds nothing new.
    """
    n = len(diagonal)
    out = np.zeros((n, len(values)))
    close = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLOSE * values[0]:
            close = j
        gamma, down, up = _twisted(diagonal, beside, value)
        best = 0.0
        for twist in np.argsort(np.abs(gamma), kind="stable")[: 2 * (j - close) + 1]:
            z = np.zeros(n)
            z[twist] = 1.0
            for k in range(twist - 1, -1, -1):
                z[k] = -down[k] * z[k + 1]
            for k in range(twist, n - 1):
                z[k + 1] = -up[k] * z[k]
            z /= np.linalg.norm(z)
            for _ in range(2):
                z -= out[:, close:j] @ (out[:, close:j].T @ z)
            norm = np.linalg.norm(z)
            if norm > best:
                best, out[:, j] = norm, z / norm
            if norm > 0.5:
                break
    return out


# Passes over the rows


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: x becomes (x - mean) @ directions / deviations."""

    n: int
    whole: np.ndarray  # integer part of the grid mean, without the offset
    rest: np.ndarray  # n times what is left of it
    directions: np.ndarray  # dimension x components
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float

    def sums(self) -> list[int]:
        """Sum of x over the fit list per dimension."""
        return [self.n * (int(w) + OFFSET) + int(r) for w, r in zip(self.whole, self.rest)]


def _grid(column: pa.Array, length: int) -> np.ndarray:
    """floor(64 c) of every entry, as integers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    scaled = np.floor(GRID * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(-1, length)
    if np.abs(scaled).max(initial=0.0) >= 2.0**62:
        raise ValueError("a vector entry is too large for the grid")
    return scaled.astype(np.int64)


def _packed(length: int):
    """Map function: every grid vector in the narrowest of three widths that holds it, so equal ones are equal bytes."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            grid = _grid(batch.column(0), length)
            most = np.abs(grid + (grid < 0)).max(axis=1, initial=0)
            out: list[bytes] = [b""] * len(grid)
            below = -1
            for kind in (np.int16, np.int32, np.int64):
                at = np.flatnonzero((most > below) & (most <= np.iinfo(kind).max))
                below = np.iinfo(kind).max
                data, width = grid[at].astype(kind).tobytes(), length * np.dtype(kind).itemsize
                for k, row in enumerate(at):
                    out[row] = data[k * width : (k + 1) * width]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["x"])

    return run


def _unpacked(column: pa.Array, length: int) -> np.ndarray:
    rows = column.to_pylist()
    out = np.empty((len(rows), length), dtype=np.int64)
    for width in {len(r) for r in rows}:
        at = [k for k, r in enumerate(rows) if len(r) == width]
        out[at] = np.frombuffer(b"".join(rows[k] for k in at), dtype=f"<i{width // length}").reshape(-1, length)
    return out


def _sums(length: int):
    """Map function: rows (at -1) and sums per dimension, the sums in two halves of 32 bits that cannot overflow."""

    def run(batches: Iterator[pa.RecordBatch]):
        high, low, rows = np.zeros(length, dtype=np.int64), np.zeros(length, dtype=np.int64), 0
        for batch in batches:
            grid = _unpacked(batch.column(0), length)
            high += (grid >> 32).sum(axis=0)
            low += (grid & 0xFFFFFFFF).sum(axis=0)
            rows += len(grid)
        names = ["at", "high", "low"]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, length)), pa.array([0, *high]), pa.array([rows, *low])], names=names)

    return run


def _centred(grid: np.ndarray, whole: np.ndarray, rest: np.ndarray, n: int) -> np.ndarray:
    """x - S/n with one rounding at the end: the integer part cancels exactly."""
    return (grid - whole) - rest / n


def _triangle(stacked: np.ndarray) -> np.ndarray:
    return np.linalg.qr(stacked, mode="r")


def _triangles(length: int, whole, rest, n):
    """Map function: one triangle per task, from blocks of centred rows below the triangle so far."""

    def run(batches: Iterator[pa.RecordBatch]):
        r, used = np.zeros((0, length)), False
        for batch in batches:
            used |= batch.num_rows > 0
            for at in range(0, batch.num_rows, 4 * length + 256):
                grid = _unpacked(batch.column(0).slice(at, 4 * length + 256), length)
                r = _triangle(np.vstack([r, _centred(grid, whole, rest, n)]))
        if used:
            group = TaskContext.get().partitionId() % FIRST_GROUPS
            yield pa.RecordBatch.from_arrays([pa.array([group], pa.int64()), pa.array([_upper(r)])], names=["part", "r"])

    return run


def _upper(r: np.ndarray) -> bytes:
    """Entries on and above the diagonal, with zero rows below a short triangle."""
    full = np.zeros((r.shape[1], r.shape[1]))
    full[: len(r)] = r[: len(full)]
    return full[np.triu_indices(len(full))].tobytes()


def _square(data: bytes, length: int) -> np.ndarray:
    out = np.zeros((length, length))
    out[np.triu_indices(length)] = np.frombuffer(data)
    return out


def _met(length: int):
    def run(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        r = np.zeros((0, length))
        for data in parts["r"]:
            r = _triangle(np.vstack([r, _square(data, length)]))
        return pd.DataFrame({"part": [key[0]], "r": [_upper(r)]})

    return run


def _products(length: int, whole, rest, n, turn):
    """Map function: sums of the whitened rows (row -1) and of their products."""
    k = turn.shape[1]
    i, j = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]):
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = _centred(_unpacked(batch.column(0), length), whole, rest, n) @ turn
            sums += w.sum(axis=0)
            products += w.T @ w
        columns = [np.concatenate([np.full(k, -1), i]), np.concatenate([np.arange(k), j]), np.concatenate([sums, products[i, j]])]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["i", "j", "v"])

    return run


def _usable(rows: DataFrame, column: str) -> tuple[DataFrame, int]:
    """Rows whose vectors can be fitted, and the vectors' length."""
    finite = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    sound = rows.where(F.col(column).isNotNull() & (F.size(column) > 0) & F.coalesce(finite, F.lit(False)))
    commonest = sound.groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    length = commonest["d"] if commonest else 1
    return sound.where(F.size(column) == length), length


def fit(rows: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a table's distinct grid vectors; None without any vector."""
    spark = rows.sparkSession
    ship(spark)
    sound, length = _usable(rows.select(column), column)
    return _fitted(sound, length, components)


def _fitted(vectors: DataFrame, length: int, components: int) -> Whitening | None:
    listed = hand_off(map_arrow(vectors, _packed(length), "x binary").distinct(), "fit")
    sums = map_arrow(listed, _sums(length), "at long, high long, low long").groupBy("at")
    wide = "decimal(38,0)"
    told = {r["at"]: (int(r["h"]), int(r["l"])) for r in sums.agg(F.sum(F.col("high").cast(wide)).alias("h"), F.sum(F.col("low").cast(wide)).alias("l")).collect()}
    n = told.get(-1, (0, 0))[1]
    if not n:
        return None
    means = [divmod((told[k][0] << 32) + told[k][1], n) for k in range(length)]
    whole, rest = (np.array(x, dtype=np.int64) for x in zip(*means))
    parts = map_arrow(listed, _triangles(length, whole, rest, n), "part long, r binary")
    groups = FIRST_GROUPS
    while groups > 1:
        groups //= MEET
        parts = parts.groupBy((F.col("part") % groups).alias("part")).applyInPandas(_met(length), "part long, r binary")
    r = _square(parts.first()["r"], length)

    diagonal, beside, right = bidiagonal(r)
    squares = squared_singular_values(diagonal, beside)
    noise = (8 * length * EPS) ** 2 * squares[0]
    k = min(components, int((squares > noise).sum()))
    directions = right @ right_vectors(diagonal, beside, squares[:k])
    variances = squares[:k] / n
    turn = directions / np.sqrt(variances)
    error = 0.0
    if k:
        made = map_arrow(listed, _products(length, whole, rest, n, turn), "i long, j long, v double").groupBy("i", "j")
        mean, second = np.zeros(k), np.zeros((k, k))
        for row in made.agg(F.sum("v").alias("v")).collect():
            if row["i"] < 0:
                mean[row["j"]] = row["v"] / n
            else:
                second[row["i"], row["j"]] = second[row["j"], row["i"]] = row["v"] / n
        error = float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())
    return Whitening(n, whole, rest, directions, variances, squares[:k] / squares.sum() if k else squares[:0], error)


def _transformed(model: Whitening, length: int):
    turn = model.directions / np.sqrt(model.variances)
    k = turn.shape[1]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            grid = _grid(batch.column("vector"), length)
            w = _centred(grid, model.whole, model.rest, model.n) @ turn
            apart = grid - model.whole
            if length * (model.n * (np.abs(apart).max(initial=0) + 1.0)) ** 2 >= 2.0**63:
                raise OverflowError("deviations do not fit into 63 bits")
            deviation = ((model.n * apart - model.rest) ** 2).sum(axis=1)
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * k)
            whitened = pa.ListArray.from_arrays(ends, pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(deviation), whitened], names=["key", "deviation", "whitened"])

    return run


def whiten(rows: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """(key, deviation, whitened) of every row that can be fitted, and the model it was fitted with.

    ``whitened`` holds one number per component, by falling variance; ``deviation`` the sum over the dimensions of
    (n x - S) squared.
    """
    ship(rows.sparkSession)
    sound, length = _usable(rows.select(F.col(key).alias("key"), F.col(column).alias("vector")), "vector")
    model = _fitted(sound.select("vector"), length, components)
    schema = f"key {rows.schema[key].dataType.simpleString()}, deviation long, whitened array<double>"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key), None
    return map_arrow(sound, _transformed(model, length), schema).withColumnRenamed("key", key), model


def op13_whitening(embeddings: DataFrame) -> DataFrame:
    """The contract's columns, one row per vector and component."""
    made, model = whiten(embeddings)
    shares = F.array(*[F.lit(float(x)) for x in model.explained]) if model else F.array()
    return made.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares.cast("array<double>"), F.col("at")).alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )
