from pyspark.sql import functions as F

from shelfwise.operators.rows import keep_first
from shelfwise.session import scratch_path
from shelfwise.sources.tables import table
from shelfwise.streaming import arrivals, first_seen

SCHEMA = "url string, event_id long"


def run(spark, source, store, progress):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    first_seen.first_seen_stream(stream, "url", ["event_id"], store, progress).awaitTermination()
    return first_seen.read_store(spark, store, spark.createDataFrame([], SCHEMA).schema)


def test_stream_keys_equal_batch_keys_and_restart_adds_only_new(spark, folder):
    events = table(spark, folder, "events").select(
        F.concat(F.col("user_id").cast("string"), "props").alias("url"), "event_id"
    )
    source, store, progress = (scratch_path(spark, x) for x in ("src", "store", "progress"))
    half = events.agg(F.expr("percentile(event_id, 0.5)")).first()[0]
    events.where(F.col("event_id") < half).coalesce(1).write.parquet(source)
    got = run(spark, source, store, progress)
    early = events.where(F.col("event_id") < half)
    assert sorted((r.url, r.event_id) for r in got.collect()) == sorted(
        (r.url, r.event_id) for r in keep_first(early, ["url"], ["event_id"]).collect()
    )
    # A restart continues from its progress; later repeats of a key are not added.
    events.where(F.col("event_id") >= half).coalesce(1).write.mode("append").parquet(source)
    got = run(spark, source, store, progress)
    assert sorted((r.url, r.event_id) for r in got.collect()) == sorted(
        (r.url, r.event_id) for r in keep_first(events, ["url"], ["event_id"]).collect()
    )
    # A replay of everything into the same store leaves it as it was.
    again = run(spark, source, store, scratch_path(spark, "progress"))
    keys = sorted(r.url for r in again.collect())
    assert keys == sorted(set(keys))


def test_batches_read_their_own_rows_whatever_came_before(spark):
    source, store, progress = (scratch_path(spark, x) for x in ("src", "store", "progress"))
    batches = 25
    rows = [(f"k{k % 60}" if k % 7 else None, k) for k in range(batches * 20)]
    for b in range(batches):
        spark.createDataFrame(rows[b * 20 : b * 20 + 20], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    provider = spark.conf.get(first_seen.PROVIDER)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    running = first_seen.first_seen_stream(stream, "url", ["event_id"], store, progress)
    running.awaitTermination()
    assert spark.conf.get(first_seen.PROVIDER) == provider
    told = [p for p in running.recentProgress if p["numInputRows"]]
    assert len(told) == batches and {p["numInputRows"] for p in told} == {20}
    # One scan, that of the source: neither the store nor earlier batches are read again.
    plan = running._jsq.explainInternal(False)
    assert store.split("/")[-1] not in plan and "Join" not in plan and plan.count("FileScan") <= 1
    assert any("rocksdb" in m.lower() for m in told[-1]["stateOperators"][0]["customMetrics"])
    assert told[-1]["stateOperators"][0]["numRowsTotal"] == 61
    got = sorted((str(r.url), r.event_id) for r in first_seen.read_store(spark, store, spark.createDataFrame([], SCHEMA).schema).collect())
    first = {}
    for url, k in rows:
        first.setdefault(str(url), k)
    assert got == sorted(first.items())


def test_merging_arrivals_reads_only_the_newest_entries(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name, v in (("a_1.csv", 1), ("a_2.csv", 2), ("b_1.csv", 3)):
        (folder / name).write_text(f"k,v\nx{v},{v}\n", encoding="utf-8")
    log = str(tmp_path / "log")
    arrivals.arrivals_stream(spark, str(folder), "k string, v int", ["a", "b"], log, str(tmp_path / "p"), 1).awaitTermination()
    merged = arrivals.merged(spark, log, "k string, v int", "k")
    assert sorted(r.v for r in merged.collect()) == [2, 3]
    files = [f for f in merged.inputFiles() if f.endswith(".parquet")]
    assert len(files) == 2 and not [f for f in files if "a_1.csv" in f]
    # Data files of older entries may even be gone: none is opened to find the newest.
    for old in (tmp_path / "log").glob("source_rank=*/entry=a_1.csv/*/*.parquet"):
        old.write_bytes(b"no parquet")
    assert sorted(r.v for r in arrivals.merged(spark, log, "k string, v int", "k").collect()) == [2, 3]
    assert arrivals.merged(spark, str(tmp_path / "none"), "k string, v int", "k").count() == 0
