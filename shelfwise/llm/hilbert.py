"""Approximate nearest neighbours by cosine, from several shifted Hilbert orderings.

Each of ``CURVES`` curves projects the unit vectors on ``DIMS`` random directions, shifts the
grid by a random offset and takes the Hilbert key of the cell; a hash of the id breaks ties, so
equal keys spread too. Range partitioning by key cuts each curve into blocks of about
``BLOCK`` vectors. A query goes to its own block and to the ``width`` blocks on either side of it, on
every curve; blocks score it exactly in double precision, and the best over all curves win.

``width`` is not a guess: a sample of ``CALIBRATE`` vectors (first by hash, and as long as there are
others none that is asked for) is compared with all, and ``width`` becomes the least that finds
``RECALL`` of their true neighbours. On data
with structure a few blocks do; on vectors without any the windows grow until recall holds,
which is then as dear as comparing with everything, but never loses recall.

Equal vectors are indexed as one with their least ids, as many as an answer can hold, so a
vector that holds a third of all rows is one entry; its other copies could never be answers.
Queries of one vector search once, for one answer more, and each leaves itself out of the result.

Defined cases: vectors that are NULL, empty, zero, or hold NULL or non-finite components take no part,
nor do those of another length than most (the longer, if two lengths tie), nor rows without id; of
rows that share an id the least vector counts; a query with no other vector has no answers; ties
go to the smaller id; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import hand_off, map_arrow, ship

CURVES, DIMS, CELL_BITS = 4, 8, 7
BLOCK = 2048
CALIBRATE, RECALL = 192, 0.96
#: Most searches that one task scores with a block; a block with more goes to several tasks.
QUERIES = 4096
SEED = 20


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each cell (rows of ``dims`` coordinates of ``bits`` bits).

    The classic transposition: undo the rotations and reflections from the top bit down, take
    the Gray code along the dimensions, and interleave the bits.
    """
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for d in range(dims):
            on = (x[d] & bit) > 0
            x[0] = np.where(on, x[0] ^ low, x[0])
            swap = np.where(on, np.uint64(0), (x[0] ^ x[d]) & low)
            x[0] ^= swap
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    fix = np.zeros(x.shape[1], dtype=np.uint64)
    for level in range(bits - 1, 0, -1):
        on = (x[-1] & np.uint64(1 << level)) > 0
        fix = np.where(on, fix ^ np.uint64((1 << level) - 1), fix)
    x ^= fix
    key = np.zeros(x.shape[1], dtype=np.uint64)
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            key = key << np.uint64(1) | (x[d] >> np.uint64(level) & np.uint64(1))
    return key


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)


def _units(v: np.ndarray) -> np.ndarray:
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _projections(length: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    axes = rng.normal(size=(CURVES, length, DIMS))
    return axes / np.linalg.norm(axes, axis=1, keepdims=True), rng.uniform(size=(CURVES, DIMS))


def _key_rows(length: int):
    axes, shifts = _projections(length)
    # Projections of unit vectors have a deviation near 1 / sqrt(length); three of them fill the grid.
    scale = np.sqrt(length) / 6

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _units(_matrix(batch.column("vector"), length))
            for c in range(CURVES):
                place = unit @ axes[c] * scale + 0.5 + (shifts[c] - 0.5) / 4
                cells = np.clip(place * (1 << CELL_BITS), 0, (1 << CELL_BITS) - 1).astype(np.int64)
                key = pa.array(hilbert_keys(cells, CELL_BITS).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(batch.num_rows, c, dtype=np.int32)), key, *batch.columns],
                    names=["curve", "key", *batch.schema.names],
                )

    return run


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best by score, ties to the smaller id."""
    if len(ids) > 4 * k:
        edge = -np.partition(-scores, k - 1)[k - 1]
        some = np.flatnonzero(scores >= edge)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines in double precision."""
    norms = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(vectors, axis=1)[None, :]
    return np.clip(queries @ vectors.T / norms, -1.0, 1.0)


def _answers(searches, queries, ids: list, vectors, k: int):
    """(search, id, score) of the k best of a block for every search; ids: each entry's ids, least first."""
    out_q, out_i, out_s = [], [], []
    sizes = np.array([len(i) for i in ids])
    flat = np.concatenate([np.asarray(i, dtype=np.int64) for i in ids])
    entry = np.repeat(np.arange(len(ids)), sizes)
    for a in range(0, len(searches), 256):
        table = _scores(queries[a : a + 256], vectors)
        for q, row in zip(searches[a : a + 256], table):
            score = row[entry]
            best = _best(flat, score, k)
            out_q.append(np.full(len(best), q))
            out_i.append(flat[best])
            out_s.append(score[best])
    return np.concatenate(out_q), np.concatenate(out_i), np.concatenate(out_s)


_FOUND = "entry long, vec_id long, score double"


def _ranked(found: DataFrame, by: str, k: int) -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k best per search over all blocks; the same pair from several curves counts once."""
    return _ranked(found.groupBy("entry", "vec_id").agg(F.max("score").alias("score")), "entry", k)


def entries(vectors: DataFrame, k: int) -> tuple[DataFrame, int]:
    """(entry, ids, vector): distinct usable vectors, named by their least id, with their k + 1 least ids; and the vectors' length."""
    good = vectors.where(
        F.col("vec_id").isNotNull()
        & (F.size("embedding") > 0)
        & ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        & F.exists("embedding", lambda v: v != 0)
    ).select(F.col("vec_id").cast("long").alias("id"), F.transform("embedding", lambda v: v.cast("double") + 0.0).alias("vector"))
    lengths = good.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    length = lengths["n"] if lengths else 1
    single = good.where(F.size("vector") == length).groupBy("id").agg(F.min("vector").alias("vector"))
    order = Window.partitionBy("vector").orderBy("id")
    kept = single.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    listed = kept.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return listed.select(F.element_at("ids", 1).alias("entry"), "ids", "vector"), length


def nearest(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score) for every id divisible by ``every``."""
    spark = vectors.sparkSession
    ship(spark)
    found, length = entries(vectors, k)
    distinct = hand_off(found, "vectors")
    count = distinct.count()
    blocks = max(1, -(-count // BLOCK))
    keyed = map_arrow(distinct, _key_rows(length), "curve int, key long, entry long, ids array<long>, vector array<double>")
    dealt = keyed.repartitionByRange(blocks * CURVES, "curve", "key", F.xxhash64("ids"))
    index = hand_off(dealt.withColumn("block", F.spark_partition_id()), "curves")
    # All ids of an entry that are queries ask, also those beyond the k + 1 least: they find the least ones.
    asking = hand_off(
        vectors.where(F.col("vec_id") % every == 0)
        .select(F.col("vec_id").cast("long").alias("query_id"), F.transform("embedding", lambda v: v.cast("double") + 0.0).alias("vector"))
        .groupBy("query_id").agg(F.min("vector").alias("vector"))
        .join(distinct.select("vector", "entry"), "vector").select("query_id", "entry"),
        "queries",
    )
    searches = hand_off(asking.select("entry").distinct(), "searches")
    width = _width(distinct, index, length, k, every)
    spans = index.groupBy("curve").agg(F.min("block").alias("low"), F.max("block").alias("high"))
    homes = index.join(searches, "entry", "left_semi").join(F.broadcast(spans), "curve")
    sent = homes.select(
        "curve",
        F.explode(F.sequence(F.greatest(F.col("block") - width, "low"), F.least(F.col("block") + width, "high"))).alias("block"),
        "entry",
        "vector",
    )
    # A task scores about QUERIES searches: a block with more goes to several, one without any to none.
    load = sent.groupBy("curve", "block").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("parts"))
    sent = sent.join(load, ["curve", "block"]).select(
        "curve", "block", F.pmod(F.xxhash64("entry"), F.col("parts")).cast("int").alias("part"), "entry", "vector"
    )
    held = index.join(load, ["curve", "block"]).select(
        F.col("curve").alias("of_curve"),
        F.col("block").alias("of_block"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("of_part"),
        F.col("ids").alias("ids"),
        F.col("vector").alias("held"),
    )

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"entry": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        q, i, s = _answers(
            left.column("entry").to_numpy(), _matrix(left.column("vector"), length), right.column("ids").to_pylist(),
            _matrix(right.column("held"), length), k + 1,
        )
        return pa.table({"entry": q, "vec_id": i, "score": s})

    pairs = (
        sent.groupBy("curve", "block", "part")
        .cogroup(held.groupBy("of_curve", "of_block", "of_part"))
        .applyInArrow(block, _FOUND)
    )
    found = asking.join(_top(pairs, k + 1).drop("rank"), "entry").where("query_id != vec_id")
    return _ranked(found, "query_id", k).select("query_id", "rank", "vec_id", "score")


def _width(distinct: DataFrame, index: DataFrame, length: int, k: int, every: int) -> int:
    """Least number of blocks on either side that finds RECALL of the sample's true neighbours."""
    spark = distinct.sparkSession
    asked = F.col("entry") % every == 0
    sample: pd.DataFrame = distinct.orderBy(asked, F.xxhash64("entry"), "entry").limit(CALIBRATE).select("entry", "vector").toPandas()
    if not len(sample):
        return 0
    ids = sample["entry"].to_numpy()
    shared = spark.sparkContext.broadcast((ids, np.array(sample["vector"].tolist(), dtype=np.float64)))

    def compare(batches):
        for batch in batches:
            if batch.num_rows:
                q, i, s = _answers(*shared.value, batch.column("ids").to_pylist(), _matrix(batch.column("vector"), length), k + 1)
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(i), pa.array(s)], names=["entry", "vec_id", "score"])

    true = _ranked(_top(map_arrow(distinct, compare, _FOUND), k + 1).where("entry != vec_id").drop("rank"), "entry", k)
    sampled = F.broadcast(spark.createDataFrame([(int(i),) for i in ids], "entry long"))
    here = index.join(sampled, "entry").select("entry", "curve", F.col("block").alias("from"))
    there = index.select(F.col("curve").alias("on"), "block", F.explode("ids").alias("vec_id"))
    apart = (
        true.select("entry", "vec_id").join(here, "entry")
        .join(there, "vec_id").where("curve = on")
        .groupBy("entry", "vec_id").agg(F.min(F.abs(F.col("from") - F.col("block"))).alias("blocks"))
        .groupBy("blocks").count().toPandas().sort_values("blocks")
    )
    reached = apart["count"].cumsum() / max(apart["count"].sum(), 1)
    enough = apart["blocks"][reached >= RECALL]
    return int(enough.iloc[0]) if len(enough) else 0


def op2_neighbours(embeddings: DataFrame) -> DataFrame:
    return nearest(embeddings).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
