"""Proportional stratified interleaving: shards of equal row counts that each match the mixture.

Rows are shuffled within their stratum by a seeded hash of their key and ranked there; the fraction
(rank + phase) / rows of the stratum spreads every stratum evenly over 0 to 1. The phase, between 0 and 1, is
the stratum's own (a hash of its name), so strata of one size do not move in step. Sorted by
fraction, any stretch of rows holds every stratum in proportion, so cutting the order into stretches
whose counts differ by one at most gives shards that match the mixture, whatever a stratum's size, to within a
few rows: less than the number of strata, as a rule its square root.

Both ranks are range sorts with counts per partition (``ranked``), so a stratum that holds most rows is
spread like any other, and no task sees more than a range.

Defined cases: a NULL stratum is a stratum of its own; rows with a NULL key or of one key are in order of the
``ties`` columns, and rows alike in those too are interchangeable; with fewer rows than shards some
shards have no row; an empty table gives no rows; the rows' own columns stay together in ``row``, so
no name can clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import hand_off
from shelfwise.llm.ranks import ranked

SHARDS = 24
SEED = 7
#: Bytes that a row costs beside its text.
ROW_BYTES = 8


def interleaved(
    rows: DataFrame, shards: int, stratum: str = "source", key: str = "doc_id", ties: Sequence[str] = (), seed: int = SEED
) -> DataFrame:
    """(row, shard, slot): every row as a struct, its shard (from 0) and its place there (from 0, without gaps)."""
    mixed = F.unhex(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary")))
    own = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"),
        F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("-")).alias("stratum"),
        mixed.alias("mixed"),
        *[F.col(t).alias(f"tie{k}") for k, t in enumerate(ties)],
    )
    order = ["mixed", *[f"tie{k}" for k in range(len(ties))]]
    within = ranked(hand_off(own, "strata"), ["stratum"], order)
    phase = (F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "stratum").cast("binary")), 1, 8), 16, 10).cast("long") + 0.5) / 2**32
    spread = hand_off(within.select("row", "stratum", ((F.col("pos") + phase) / F.col("of")).alias("fraction")), "fractions")
    whole = ranked(spread, [], ["fraction", "stratum"])
    shard = F.expr(f"(pos * {shards}) div of")
    slot = F.col("pos") - F.expr(f"(shard * of + {shards - 1}) div {shards}")
    return whole.select("row", "pos", "of", shard.alias("shard")).select("row", F.col("shard").cast("int").alias("shard"), slot.alias("slot"))


def write_shards(dealt: DataFrame, folder: str) -> None:
    """Shards as Parquet folders ``shard=k`` of (row, slot), each in slot order within its files.

    A shard is dealt over as many tasks as its share of the rows needs, by stretches of slots.
    """
    (
        dealt.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(folder)
    )


def op12_shards(documents: DataFrame) -> DataFrame:
    """The contract's columns: 24 shards of ``documents`` by the law of equal row counts. No text moves."""
    narrow = documents.select(
        "doc_id",
        "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    dealt = interleaved(narrow, SHARDS, ties=("doc_id", "size", "text_crc32"))
    return dealt.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("row.size").alias("size"),
        F.col("row.text_crc32").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
