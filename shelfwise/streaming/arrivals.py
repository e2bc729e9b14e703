"""Raw files as they arrive, merged into one table without duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfwise.operators.rows import keep_first
from shelfwise.sources.readers import belongs

ORDER = ["source_rank", "origin_file", "origin_offset", "origin_row"]


def arrivals_stream(
    spark: SparkSession, folder: str, schema: str, prefixes: Sequence[str], log: str, checkpoint: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Copy arriving CSV rows to an append-only log with their entry name and position.

    Merging happens on read: rewriting the merged table for every batch would cost its
    whole size each time.
    """
    raw = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
        .select(
            "*",
            F.col("_metadata.file_path").alias("origin_file"),
            F.col("_metadata.file_block_start").alias("origin_offset"),
        )
    )
    mark = F.lit(folder.rstrip("/").split(":")[-1] + "/")
    # File names come as addresses; a plus in them is a plus.
    plain = F.url_decode(F.replace(F.col("origin_file"), F.lit("+"), F.lit("%2B")))
    entry = F.split_part(F.substr(plain, F.instr(plain, mark) + F.length(mark)), F.lit("/"), F.lit(1))
    rank = F.coalesce(*[F.when(belongs("entry", p), F.lit(i)) for i, p in enumerate(prefixes)])

    def append(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("origin_row", F.monotonically_increasing_id())
            .withColumn("entry", entry)
            .withColumn("source_rank", rank)
            .where("source_rank is not null")
            .withColumn("batch", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("source_rank", "entry", "batch")
            .parquet(log)
        )

    return (
        raw.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def newest_entries(spark: SparkSession, log: str) -> dict[int, str]:
    """Per source the folder of its newest entry, from the log's folder names alone."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{log.rstrip('/')}/source_rank=*/entry=*")
    newest: dict[int, tuple[str, str]] = {}
    for status in pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []:
        folder = status.getPath()
        rank = int(folder.getParent().getName().partition("=")[2])
        found = unquote(folder.getName().partition("=")[2]), folder.toString()
        newest[rank] = max(found, newest.get(rank, found))
    return {rank: folder for rank, (_, folder) in newest.items()}


def merged(spark: SparkSession, log: str, schema: str, key: str) -> DataFrame:
    """The newest entry per source, first row per key in source order.

    The log is partitioned by source and entry: the newest entries are found by the names of its folders, and only
    theirs are listed and read, however long the log is.
    """
    full = T.StructType(
        [
            *spark.createDataFrame([], schema).schema.fields,
            *spark.createDataFrame(
                [], "origin_file string, origin_offset bigint, origin_row bigint, source_rank int, entry string, batch bigint"
            ).schema.fields,
        ]
    )
    folders = sorted(newest_entries(spark, log).values())
    if not folders:
        return spark.createDataFrame([], full).drop("batch")
    rows = spark.read.schema(full).option("basePath", log).parquet(*folders)
    return keep_first(rows.drop("batch"), [key], ORDER)
