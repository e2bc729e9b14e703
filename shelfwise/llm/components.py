"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import cut_lineage

#: Rounds before giving up with an error; each at least halves the length of every path.
MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(id, component): for every id in ``links`` (a, b), the least id that it reaches.

    Links may repeat and point either way. Each round ties every neighbour of a node to the
    least one it knows; the minima combine before the shuffle, so a hub sends one row per task.
    Every round is cut off by a checkpoint. Ends when a round changes nothing.
    """
    edges = cut_lineage(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = None
    for _ in range(MOST_ROUNDS):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(below, "a")
        edges = cut_lineage(
            joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionAll(below.select("a", F.col("m").alias("b")))
            .distinct()
        )
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    known = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id")
    return known.unionAll(edges.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component")))
