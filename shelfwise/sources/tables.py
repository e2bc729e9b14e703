"""Access to the parquet tables of a data folder, and frames derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def spread(scan: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal a scan's rows out to so many partitions, if the caller asks for it.

    For heavy work per record (page markup, long texts) on few or unsplittable files; the
    default leaves the scan as it is.
    """
    return scan if partitions is None else scan.repartition(partitions)


def width(spark: SparkSession) -> int:
    """The session's parallelism, for callers that want their rows dealt out."""
    return spark.sparkContext.defaultParallelism


def part_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """``part`` with missing values set by a fixed rule on the key (the tables hold none)."""
    key = F.col("p_partkey")

    def gap(column: str, step: int):
        return F.when(key % step != 0, F.col(column)).alias(column)

    return table(spark, folder, "part").select(
        "p_partkey",
        "p_name",
        gap("p_brand", 11),
        gap("p_type", 5),
        gap("p_size", 13),
        gap("p_retailprice", 7),
    )


def orders_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(key % 7 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.when(key % 5 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(key % 11 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        F.when(key % 3 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
        "o_orderdate",
    )
