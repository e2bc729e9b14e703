"""Dictionary, membership, rule and nearest-match look-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import col
from shelfwise.session import attach, small_frame


def backfill(
    df: DataFrame, key: str, target: str, mapping: Mapping[str, object] | DataFrame
) -> DataFrame:
    """Fill ``target`` from a (key -> value) mapping, only where it is missing."""
    literal = not isinstance(mapping, DataFrame)
    if literal:
        value_type = df.schema[target].dataType.simpleString()
        key_type = df.schema[key].dataType.simpleString()
        mapping = small_frame(
            df.sparkSession, list(mapping.items()), f"`{key}` {key_type}, _fill {value_type}"
        )
    else:
        # A repeated key must not repeat rows: its greatest value fills.
        mapping = mapping.toDF(key, "_fill").groupBy(key).agg(F.max("_fill").alias("_fill"))
    order = df.columns
    filled = attach(df, mapping, [key], "left", stored=literal)
    return filled.withColumn(target, F.coalesce(target, "_fill")).select(*order)


def mapped(c: Column | str, mapping: Mapping) -> Column:
    """Value of a small fixed mapping; anything unmatched is NULL."""
    pairs = F.create_map(*[F.lit(x) for item in mapping.items() for x in item])
    return F.try_element_at(pairs, col(c))


def keep_members(df: DataFrame, column: str, members: DataFrame) -> DataFrame:
    """Rows whose value is in the one-column set."""
    return attach(df, members.select(F.col(members.columns[0]).alias(column)), [column], "left_semi")


def drop_members(df: DataFrame, column: str, members: DataFrame) -> DataFrame:
    return attach(df, members.select(F.col(members.columns[0]).alias(column)), [column], "left_anti")


def attach_by_key(df: DataFrame, computed: DataFrame, key: str) -> DataFrame:
    """Columns computed elsewhere, joined on the record key and never by position."""
    return df.join(computed, key, "left")


def nearest(
    point: Sequence[Column | str], references: Mapping[str, Sequence[float]], missing: str = "Unknown"
) -> Column:
    """Name of the reference point with the smallest L1 distance; the first wins a tie.

    The reference list is part of the expression, so no row is paired with another row.
    """
    axes = [col(c).cast("double") for c in point]
    candidates = []
    for order, (name, place) in enumerate(references.items()):
        distance = sum((F.abs(a - F.lit(float(p))) for a, p in zip(axes, place)), F.lit(0.0))
        candidates.append(F.struct(distance.alias("d"), F.lit(order).alias("o"), F.lit(name).alias("name")))
    known = axes[0].isNotNull()
    for a in axes[1:]:
        known = known & a.isNotNull()
    return F.when(known, F.array_min(F.array(*candidates))["name"]).otherwise(F.lit(missing))


def by_ordered_words(c: Column | str, words: Mapping[str, str], otherwise: str = "Other") -> Column:
    """Label of the first word the text starts with, else of the first it contains."""
    text = F.lower(col(c))
    chain = None
    for test in (text.startswith, text.contains):
        for word, label in words.items():
            chain = F.when(test(word), label) if chain is None else chain.when(test(word), label)
    return chain.otherwise(otherwise)


def unseen(batch: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows of a batch whose key no earlier batch had. Both sides may be large."""
    return batch.join(seen.select(key), key, "left_anti")
