"""Category encoding, scaling and projection to two dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import fixed_values as fx
from shelfwise.functions import phone as ph
from shelfwise.functions.numeric import no_nan
from shelfwise.operators import lookup
from shelfwise.operators.aggregate import top_values
from shelfwise.operators.rows import drop_present
from shelfwise.session import attach, cut_lineage, one_row, small_frame

#: Levels of one column that become columns of a table; Spark limits such windows before their shuffle up to 1,000 rows.
MOST_LEVELS = 900


def group_rare(df: DataFrame, column: str, k: int, into: str, other: str = "Other") -> DataFrame:
    """Keep the k most frequent levels; everything else, and missing, becomes ``other``."""
    kept = top_values(df, column, k).select(F.col("value").alias(column), F.lit(True).alias("_kept"))
    order = df.columns
    joined = attach(df, kept, [column], "left")
    return joined.withColumn(into, F.when(F.col("_kept"), F.col(column)).otherwise(other)).select(
        *dict.fromkeys([*order, into])
    )


def top_levels(df: DataFrame, columns: Mapping[str, int]) -> dict[str, tuple[list[str], bool]]:
    """Per column its most frequent levels as text, by falling count then value, and whether any row has none of them.

    All columns are counted in one pass and one shuffle of (column, level) counts; ``columns`` says how many
    levels of each to fetch, and no more than these reach the driver.
    """
    pairs = ", ".join(f"'{c}', cast(`{c}` as string)" for c in columns)
    counts = df.select(F.expr(f"stack({len(columns)}, {pairs}) as (metric, v)")).groupBy("metric", "v").agg(F.count("*").alias("c"))
    # The missing value comes first and one level beyond the wanted ones is fetched: either means other rows.
    order = Window.partitionBy("metric").orderBy(F.isnotnull("v"), F.desc("c"), "v")
    found = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= max(columns.values()) + 2).collect()
    out = {}
    for c, k in columns.items():
        mine = sorted((r["place"], r["v"]) for r in found if r["metric"] == c)
        levels = [v for _, v in mine if v is not None]
        out[c] = (levels[:k], len(mine) > len(levels[:k]))
    return out


def levels_of(df: DataFrame, columns: Sequence[str], most: int = MOST_LEVELS) -> dict[str, list[str]]:
    """Sorted present levels per column: what a table with a column per level has in its header.

    A column with more than ``most`` levels is an error.
    """
    out = {}
    if columns:
        for c, (levels, _) in top_levels(df, {c: most + 1 for c in columns}).items():
            if len(levels) > most:
                raise ValueError(f"{c} has more than {most} levels: give its levels, or take one_hot_long")
            out[c] = sorted(levels)
    return out


def one_hot_long(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, code, level): the ones of a one-hot table, row by row, for any number of levels.

    Nothing is fetched; codes number the sorted levels from 0. Rows without a value have none.
    """
    present = df.where(F.col(column).isNotNull()).select(key, F.col(column).cast("string").alias("level"))
    coded = dense_codes(present.select("level").distinct(), "level", "code")
    return attach(present, coded, ["level"], "inner").select(key, F.col("code").cast("long").alias("code"), "level")


def one_hot(
    df: DataFrame,
    columns: Sequence[str],
    drop_first: bool = True,
    keep_source: bool = False,
    missing: str | None = None,
    levels: Mapping[str, Sequence[str]] | None = None,
    most: int = MOST_LEVELS,
) -> DataFrame:
    """0/1 columns ``column_level`` per level, in sorted order; a missing value sets none.

    Levels that are not given are found in one pass for all columns, ``most`` of each at the most.
    """
    out = df
    flags = []
    values = {c: F.col(c).cast("string") if missing is None else F.coalesce(F.col(c).cast("string"), F.lit(missing)) for c in columns}
    unknown = [c for c in columns if c not in (levels or {})]
    known = {**(levels or {}), **levels_of(df.select(*[values[c].alias(c) for c in unknown]), unknown, most)}
    for c, value in values.items():
        flags += [
            F.coalesce(value == level, F.lit(False)).cast("int").alias(f"{c}_{level}")
            for level in list(known[c])[1 if drop_first else 0 :]
        ]
    kept = [F.col(f"`{c}`") for c in out.columns if keep_source or c not in columns]
    return out.select(*kept, *flags)


def label_codes(df: DataFrame, column: str, into: str, missing: str = "Unknown") -> DataFrame:
    """Sorted levels to 0..n-1; a missing value is a level of its own.

    The level table is ranked through a range sort and per-partition offsets, so even very
    many levels are numbered without gathering them in one task.
    """
    filled = df.withColumn(column, F.coalesce(F.col(column).cast("string"), F.lit(missing)))
    levels = filled.select(column).distinct()
    codes = dense_codes(levels, column, into)
    return attach(filled, codes, [column], "left").select(*df.columns, into)


def dense_codes(levels: DataFrame, column: str, into: str) -> DataFrame:
    """0..n-1 for a column of distinct values in sorted order.

    A range sort numbers the rows inside each partition; only one count per partition is
    fetched to turn these into running numbers.
    """
    numbered = cut_lineage(
        levels.select(column).orderBy(column).withColumn("_m", F.monotonically_increasing_id())
    ).select(column, F.shiftright("_m", 33).alias("_part"), F.col("_m").bitwiseAND((1 << 33) - 1).alias("_m"))
    sizes = sorted(tuple(r) for r in numbered.groupBy("_part").count().collect())
    starts, total = [], 0
    for part, size in sizes:
        starts.append((part, total))
        total += size
    offsets = small_frame(levels.sparkSession, starts, "_part bigint, _start bigint")
    return numbered.join(F.broadcast(offsets), "_part").select(
        column, (F.col("_start") + F.col("_m")).alias(into)
    )


def ordinal_codes(df: DataFrame, column: str, mapping: Mapping[str, int], into: str) -> DataFrame:
    return df.withColumn(into, lookup.mapped(column, mapping))


def booleans_to_int(df: DataFrame) -> DataFrame:
    flags = {f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)}
    return df.select(
        *[F.col(f"`{c}`").cast("int").alias(c) if c in flags else F.col(f"`{c}`") for c in df.columns]
    )


def standard_scaled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation; a column without spread becomes 0."""
    stats = one_row(
        df.agg(
            *[f(no_nan(c)).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))]
        )
    )
    return df.withColumns(
        {
            c: F.when(stats[f"s_{c}"] > 0, (no_nan(c) - stats[f"m_{c}"]) / stats[f"s_{c}"]).otherwise(
                no_nan(c) - stats[f"m_{c}"]
            )
            for c in columns
        }
    )


def two_components(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """First two principal components of complete, scaled rows; the largest loading is positive.

    One aggregate gives every pair's correlation and every column's mean and deviation, so the driver holds a
    columns x columns matrix; its two leading eigenvectors become weights of a sum over the row's own columns.
    Columns without spread have no weight; with one column alone the second component is 0.
    """
    complete = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns]).na.drop(subset=list(columns))
    # Pairs are made by array functions, so the expression does not grow with the square of the columns.
    pairs = F.transform(
        "_x", lambda a, i: F.transform(F.slice("_x", F.lit(1), i + 1), lambda b, j: F.struct(i.alias("i"), j.alias("j"), a.alias("a"), b.alias("b")))
    )
    moments = (
        complete.select(F.array(*columns).alias("_x")).select(F.inline(F.flatten(pairs))).groupBy("i", "j")
        .agg(F.avg("a").alias("mean"), F.stddev_pop("a").alias("s"), F.covar_pop("a", "b").alias("v"))
        .collect()
    )
    means, spreads = [0.0] * len(columns), [0.0] * len(columns)
    for r in moments:
        if r["i"] == r["j"]:
            means[r["i"]], spreads[r["i"]] = r["mean"], r["s"]
    matrix = np.zeros((len(columns), len(columns)))
    for r in moments:
        scale = spreads[r["i"]] * spreads[r["j"]]
        matrix[r["i"], r["j"]] = matrix[r["j"], r["i"]] = r["v"] / scale if scale > 0 else 0.0
    vectors = np.linalg.eigh(matrix)[1][:, ::-1]

    def component(k: int) -> Column:
        total = F.lit(0.0)
        if k < len(columns):
            v = vectors[:, k] * (1.0 if vectors[np.abs(vectors[:, k]).argmax(), k] >= 0 else -1.0)
            for c, m, s, w in zip(columns, means, spreads, v):
                if s > 0:
                    total = total + (F.col(c) - float(m)) / float(s) * float(w)
        return total.alias(f"pc_{k + 1}")

    return complete.select(*keep, component(0), component(1))


def resolution_class(df: DataFrame, column: str = "screen_resolution") -> DataFrame:
    """Adds ``screen_resolution_k``, the named size nearest to 'a x b'."""
    return df.withColumn("screen_resolution_k", lookup.nearest(ph.sides(column), fx.K_RESOLUTIONS))


def brand_and_os(df: DataFrame, name: str = "name") -> DataFrame:
    return df.withColumn("brand", lookup.by_ordered_words(name, fx.BRAND_WORDS)).withColumn(
        "os", ph.operating_system("brand")
    )


def encoded_table(
    df: DataFrame,
    rare: Mapping[str, int],
    categories: Sequence[str] = (),
    ordinal: Mapping[str, Mapping[str, int]] | None = None,
    drop: Sequence[str] = fx.TEXT_COLUMNS_TO_DROP,
) -> DataFrame:
    """Model-ready table: rare levels grouped, one-hot, ordinal codes, text columns dropped.

    ``rare`` maps a column to its number of kept levels; the encoded columns are named
    after ``<column>_grouped``. Levels of all columns come from one pass; the kept ones are
    few, so rows are grouped by comparison with literals, without a join.
    """
    found = top_levels(df, {**rare, **{c: MOST_LEVELS + 1 for c in categories}}) if rare or categories else {}
    out, levels = df, {}
    for c in rare:
        kept, others = found[c]
        out = out.withColumn(f"{c}_grouped", F.when(F.col(c).cast("string").isin(kept), F.col(c).cast("string")).otherwise("Other"))
        levels[f"{c}_grouped"] = sorted({*kept, *(["Other"] if others else [])})
    for c in categories:
        if len(found[c][0]) > MOST_LEVELS:
            raise ValueError(f"{c} has more than {MOST_LEVELS} levels: group its rare ones")
        levels[c] = sorted(found[c][0])
    out = one_hot(out, list(levels), levels=levels)
    for c, mapping in (ordinal or {}).items():
        out = ordinal_codes(out, c, mapping, f"{c}_encoded")
    return booleans_to_int(drop_present(out, drop))
