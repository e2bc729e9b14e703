"""Session settings and the few places where a job has to touch shared storage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type


_scopes: list[str] = []


def build_session(app: str = "shelfwise", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on. Shuffle width stays the cluster's choice."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can see, as the cluster names it.

    Without that setting it lies in the session's warehouse. Spark's default for that is a local
    folder, so on a cluster one of the two has to be set to a shared one.
    """
    return _scopes[-1] if _scopes else _base_dir(spark)


def _base_dir(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for a written hand-off."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A scope for hand-offs: what is stored inside is deleted at its end, also after an error.

    Results of the scope have to be written or fetched before it ends.
    """
    folder = scratch_path(spark, "scope")
    _scopes.append(folder)
    try:
        yield folder
    finally:
        _scopes.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_frame(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """Literal rows as a local relation, whose size the planner knows."""
    types = spark.createDataFrame([], schema).schema
    columns = list(zip(*rows)) if rows else [()] * len(types)
    arrow = pa.table(
        {f.name: pa.array(list(v), to_arrow_type(f.dataType)) for f, v in zip(types.fields, columns)}
    )
    return spark.createDataFrame(arrow, types)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute a frame once into reliable storage, so that losing executors costs nothing."""
    spark = df.sparkSession
    folder = _base_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def hand_off(df: DataFrame, label: str) -> DataFrame:
    """Write a large intermediate table as parquet and go on from there.

    For a frame that several later passes read: it is computed once, later passes read
    only their columns, and a lost executor re-reads a file instead of recomputing.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """``hand_off`` of the frame that ``build`` makes; what it stored on the way is deleted."""
    path = scratch_path(spark, label)
    with scratch(spark):
        df = build()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def attach(big: DataFrame, small: DataFrame, on: list[str], how: str = "left", stored: bool = False) -> DataFrame:
    """Join a derived table (unique in ``on``) to a fact table.

    The derived side is written once, so the planner knows its bytes and broadcasts it by its
    own threshold; beyond that it is a sort-merge join whose hot keys adaptive execution splits.
    ``stored`` says that the side is a stored table, or literal rows, already.
    """
    return big.join(small if stored else hand_off(small, "side"), on, how)


def one_row(df: DataFrame) -> dict[str, Column]:
    """The single row of an aggregate as literals.

    One row of numbers is all that reaches the driver. Inlined, they keep later plans
    flat: no join with a one-row frame, and the aggregate runs once however often it is used.
    """
    row = df.first()
    return {
        f.name: F.lit(None if row is None else row[f.name]).cast(f.dataType) for f in df.schema.fields
    }
