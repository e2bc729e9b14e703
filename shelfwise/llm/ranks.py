"""Places of all rows in an order, by range partitions and the counts of their parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import attach, hand_off

#: ``monotonically_increasing_id`` holds the partition above and the row below this bit.
_ROW_BITS = 33


def ranked(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The rows with ``pos`` (place from 0 among the rows of their group) and ``of`` (how many those are).

    ``rows`` should be a stored table, as its sort keys are read once more to find the ranges. A group of
    any size is spread over partitions: one range sort by group and order, then each partition tells
    how many rows of each group it holds, which places its first one. Rows that tie in the whole order
    are dealt apart too (any of them may come first). Group columns hold no NULL; ``order`` is ascending, NULL first.
    """
    keys = group or ["_all"]
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    if not group:
        tied = tied.withColumn("_all", F.lit(0))
    by = [*group, *order, "_tie"]
    # The id after the sort tells range and row; stored, it stays what it is, however the files are read.
    placed = hand_off(
        tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "sorted"
    ).withColumn("_part", F.shiftright("_at", _ROW_BITS))
    counts = placed.groupBy(*keys, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    edges = counts.select(
        *keys,
        "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("of"),
    )
    joined = attach(placed, edges, [*keys, "_part"], "inner")
    return joined.select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("pos"), "of")
