"""What the operators of this subpackage share: tables, stored intermediates, shipping of code."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import shelfwise
from shelfwise.llm import arrays
from shelfwise.session import hand_off, settled
from shelfwise.sources.tables import table

_shipped: set[str] = set()

__all__ = ["extended", "filter_place", "filter_words", "hand_off", "lean_group", "map_arrow", "sample_texts", "settled", "ship", "sifted", "table"]
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: A text beyond this many bytes is left out of bounded samples to fit on (never out of scoring).
SAMPLE_TEXT_BYTES = 1 << 18
#: Bits of a filter of keys; a crowded one only costs time.
FILTER_BITS = 1 << 23


def ship(spark: SparkSession) -> None:
    """Give the executors this package (once per application), wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(shelfwise.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="shelfwise-code-"), "shelfwise_code.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def extended(df: DataFrame, more: str, without: tuple[str, ...] = ()) -> T.StructType:
    """The frame's columns (but for ``without``), whatever their names, and those of a DDL text."""
    return T.StructType([f for f in df.schema.fields if f.name not in without] + T.StructType.fromDDL(more).fields)


def map_arrow(df: DataFrame, fn, schema: str | T.StructType, lean: bool = False) -> DataFrame:
    """``mapInArrow`` with the package present on the executors.

    ``lean``: give back what the worker still holds, of earlier stages too, before and after the task.
    """
    spark = df.sparkSession
    ship(spark)
    # Long texts make large batches; unless the session asks for another size, send fewer rows at a time.
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "1000")
    return df.mapInArrow(_released(fn) if lean else fn, schema)


def _released(fn):
    def run(batches):
        arrays.release()
        try:
            yield from fn(batches)
        finally:
            arrays.release()

    return run


def lean_group(fn):
    """A function of one group that gives freed memory back after each: a worker takes many groups, of all sizes."""

    def run(group):
        try:
            return fn(group)
        finally:
            arrays.trim()

    return run


def sample_texts(documents: DataFrame, most: int) -> list[str]:
    """At most ``most`` distinct texts, those that come first by hash, in that order.

    Only hashes are sorted; the texts are fetched below the last one's hash, copies once.
    """
    hashed = documents.where(F.octet_length("text") <= SAMPLE_TEXT_BYTES).select("text", F.xxhash64("text").alias("h"))
    last = hashed.select("h").distinct().orderBy("h").limit(most).agg(F.max("h")).first()[0]
    if last is None:
        return []
    rows = hashed.where(F.col("h") <= last).groupBy("h").agg(F.min("text").alias("text")).collect()
    return [r["text"] for r in sorted(rows, key=lambda r: r["h"])][:most]


def filter_place(*columns: Column | str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(FILTER_BITS))


def filter_words(places: DataFrame) -> DataFrame:
    """(w, v): the filter of the places ``h`` in words of 64 bits, FILTER_BITS / 64 rows at most."""
    return places.groupBy((F.col("h") / 64).cast("long").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(h % 64 as int))")).alias("v")
    )


def sifted(df: DataFrame, own: list[Column], keys: DataFrame, among: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows whose key ``own`` is surely not in ``keys``, and the others, few of which are not in it either.

    For a join of wide rows with keys that few of them have: only the second part has to be shuffled. Just the rows
    that meet ``among`` can come into the second part.
    """
    words = hand_off(filter_words(keys.select(filter_place(*keys.columns).alias("h"))), "filter")
    place = filter_place(*own)
    hit = (place / 64).cast("long") == words["w"]
    hit &= F.getbit(words["v"], place % 64) == 1
    if among is not None:
        hit &= among
    # The filter has a fixed size, so it may always be broadcast.
    return df.join(F.broadcast(words), hit, "left_anti"), df.join(F.broadcast(words), hit, "left_semi")
