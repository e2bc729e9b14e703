"""Keep the first row per key over arriving batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_store(spark: SparkSession, store: str, schema: T.StructType) -> DataFrame:
    """The rows of all batches."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(store)


def first_seen_stream(
    stream: DataFrame, key: str, order: Sequence[str], store: str, checkpoint: str
) -> StreamingQuery:
    """Append rows with a new key to ``store``, one Parquet folder per batch; keys are never forgotten.

    Keys live in the stream's own state, a RocksDB store per shuffle partition below ``checkpoint``: a batch looks up its own
    keys and reads neither the store nor the history, however many batches there were. The state holds, per
    key, its first row and the times of the first and the last batch that had it; the times are equal for keys that are
    new, and only those are written. Rows of a batch combine per key before the shuffle; of rows of one key
    within a batch the first in order counts. State and batch times are saved with each batch and a batch owns
    its folder, so a replay after a failure overwrites its own rows and nothing else. Where a bounded delay
    between repeats is acceptable, ``dropDuplicatesWithinWatermark`` needs less state.
    """
    spark = stream.sparkSession
    row = F.struct(*[F.col(f"`{c}`") for c in stream.columns])
    arrived = stream.select(
        F.col(key).alias("key"),
        row.alias("row"),
        F.struct(F.current_timestamp().alias("at"), *[F.col(c) for c in order]).alias("place"),
    )
    state = arrived.groupBy("key").agg(
        F.min_by("row", "place").alias("row"), F.min("place.at").alias("first"), F.max("place.at").alias("last")
    )

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.where("first = last").select("row.*").write.mode("overwrite").parquet(f"{store}/batch={batch_id}")

    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)  # taken over by the query when it starts
    try:
        return (
            state.writeStream.foreachBatch(append)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(PROVIDER, before)
