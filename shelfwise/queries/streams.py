"""Incremental jobs (T). Each runs a stream over files Spark wrote from a given table."""

from pyspark.sql import functions as F

from shelfwise.queries import query
from shelfwise.queries.scans import PART_DDL, PREFIXES, _raw_folder
from shelfwise.session import scratch_path
from shelfwise.sources.tables import table
from shelfwise.streaming import arrivals, first_seen


@query("t1_first_seen_stream", "SELECT DISTINCT CAST(user_id AS VARCHAR) || props AS url FROM events")
def _(spark, d):
    events = table(spark, d, "events").select(
        F.concat(F.col("user_id").cast("string"), "props").alias("url"), "event_id", "event_type"
    )
    source, store = scratch_path(spark, "arriving"), scratch_path(spark, "seen")
    events.repartitionByRange(4, "event_id").write.parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(source)
    running = first_seen.first_seen_stream(stream, "url", ["event_id"], store, scratch_path(spark, "progress"))
    running.awaitTermination()
    return first_seen.read_store(spark, store, events.schema).select("url")


@query(
    "t2_arriving_files",
    "SELECT p_partkey, p_name, p_size, p_type FROM part WHERE p_type <> 'PROMO'",
)
def _(spark, d):
    log = scratch_path(spark, "log")
    running = arrivals.arrivals_stream(
        spark, _raw_folder(spark, d), PART_DDL, PREFIXES, log, scratch_path(spark, "progress"), files_per_batch=3
    )
    running.awaitTermination()
    return arrivals.merged(spark, log, PART_DDL, "p_partkey").select(
        "p_partkey", "p_name", "p_size", "p_type"
    )
