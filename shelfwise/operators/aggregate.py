"""Counts, profiles, correlations and pivots."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfwise.functions.numeric import no_nan, round_half_even
from shelfwise.operators.quantiles import exact_modes, exact_quantiles
from shelfwise.session import small_frame


def counted(df: DataFrame, column: str, keep_missing: bool = False) -> DataFrame:
    """(value, n) in no order."""
    rows = df if keep_missing else df.where(F.col(column).isNotNull())
    return rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def value_counts(df: DataFrame, column: str, keep_missing: bool = False, by_value: bool = False) -> DataFrame:
    """(value, n), most frequent first; equal counts in value order."""
    counts = counted(df, column, keep_missing)
    return counts.orderBy("value") if by_value else counts.orderBy(F.desc("n"), F.asc("value"))


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    return value_counts(df, column).limit(k)


def frequent_values(df: DataFrame, column: str, at_least: int) -> DataFrame:
    return counted(df, column).where(F.col("n") >= at_least)


def rare_values(df: DataFrame, column: str, below: int) -> DataFrame:
    return counted(df, column).where(F.col("n") < below)


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    row = df.agg(*[F.count_distinct(c).alias(c) for c in columns])
    return long_row(row, columns, "column_name", "n_distinct")


def long_row(row: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Turn a one-row aggregate into (name, value) rows."""
    return row.unpivot([], [F.col(f"`{c}`") for c in columns], name, value)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, min, quartiles, max per numeric column."""
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("metric"),
                F.count(no_nan(c)).alias("n_present"),
                F.avg(no_nan(c)).alias("mean"),
                F.stddev_samp(no_nan(c)).alias("std"),
                F.min(no_nan(c)).cast("double").alias("min"),
                F.max(no_nan(c)).cast("double").alias("max"),
            )
            for c in columns
        ]
    )
    moments = df.agg(cells.alias("m")).select(F.inline("m"))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        "metric", F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75")
    )
    return moments.join(quartiles, "metric", "left")


def missing_ratio(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    row = df.agg(*[F.avg(F.isnull(c).cast("int")).alias(c) for c in columns])
    return long_row(row, columns, "column_name", "missing_ratio")


def missing_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing count and percent (2 places) of the columns that miss anything."""
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count_if(F.isnull(c)).alias("n_missing"),
                F.count("*").alias("n"),
            )
            for c in columns
        ]
    )
    long = df.agg(cells.alias("m")).select(F.inline("m")).where("n_missing > 0")
    percent = round_half_even(F.col("n_missing") / F.col("n") * 100, 2)
    return long.select("column_name", "n_missing", percent.alias("percent")).orderBy(
        F.desc("percent"), "column_name"
    )


def missing_ratio_by_group(df: DataFrame, groups: dict[str, Sequence[str]]) -> DataFrame:
    """missing_ratio with a caption per column; columns the frame lacks are skipped."""
    pairs = [(g, c) for g, cs in groups.items() for c in cs if c in df.columns]
    caption = F.create_map(*[F.lit(x) for g, c in pairs for x in (c, g)])
    ratios = missing_ratio(df, [c for _, c in pairs])
    return ratios.select(
        caption[F.col("column_name")].alias("column_group"), "column_name", "missing_ratio"
    ).orderBy("column_group", F.desc("missing_ratio"), "column_name")


def count_where(df: DataFrame, **conditions: Column) -> DataFrame:
    return df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass a point of a job without a pass of its own."""
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("n_rows")), watch


def step_audit(before: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows before and after a step, and the difference: one pass counts both, the first by observing what enters."""
    entering, watch = observed(before, f"audit-{uuid.uuid4().hex}")
    after = step(entering).count()
    n = watch.get["n_rows"]
    return small_frame(before.sparkSession, [(n, after, n - after)], "n_before bigint, n_after bigint, n_removed bigint")


def present_counts(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    rows = df
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    return rows.groupBy(*keys).agg(*[F.count(c).alias(f"n_{c}") for c in columns])


def count_by(df: DataFrame, keys: Sequence[str], counted: str | None = None) -> DataFrame:
    rows = df
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    return rows.groupBy(*keys).agg(F.count(counted or F.lit(1)).alias("n"))


def ranked_group_medians(df: DataFrame, by: str, value: str, k: int | None = None) -> DataFrame:
    ranked = exact_quantiles(df, [value], [0.5], [by]).select(
        by, F.col("q0").alias("median_value"), "n"
    ).orderBy(F.desc("median_value"), by)
    return ranked.limit(k) if k else ranked


def overall_median_and_mode(df: DataFrame, number: str, text: str) -> DataFrame:
    mode = exact_modes(df, [text]).select("mode").scalar()
    return exact_quantiles(df, [number], [0.5]).select(F.col("q0").alias("median_value"), mode.alias("mode_value"))


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(x, y, r): Pearson r per pair over the rows that have both.

    No complete row, or no spread on either side, gives NULL. All pairs share one pass;
    each row adds to its pairs inside the task, so the shuffle carries one row per pair.
    """
    numbered = [
        F.struct(F.lit(i).alias("pair"), no_nan(a).alias("a"), no_nan(b).alias("b"))
        for i, (a, b) in enumerate(pairs)
    ]
    spread = F.stddev_pop("a") * F.stddev_pop("b")
    found = (
        df.select(F.inline(F.array(*numbered)))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull())
        .groupBy("pair")
        .agg(F.when(spread > 0, F.covar_pop("a", "b") / F.nullif(spread, F.lit(0.0))).alias("r"))
    )
    names = small_frame(
        df.sparkSession, [(i, a, b) for i, (a, b) in enumerate(pairs)], "pair int, x string, y string"
    )
    return names.join(found, "pair", "left").select("x", "y", "r")


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The full matrix as (x, y, r); each unordered pair is computed once."""
    lower = correlations(df, [(a, b) for i, a in enumerate(columns) for b in columns[: i + 1]])
    both = F.when(F.col("x") == F.col("y"), F.array(F.struct("x", "y", "r"))).otherwise(
        F.array(
            F.struct("x", "y", "r"),
            F.struct(F.col("y").alias("x"), F.col("x").alias("y"), F.col("r").alias("r")),
        )
    )
    return lower.select(F.inline(both))


def correlation_with(df: DataFrame, target: str, columns: Sequence[str], k: int) -> DataFrame:
    ranked = correlations(df, [(c, target) for c in columns]).select("x", "r")
    return ranked.orderBy(F.desc_nulls_last("r"), "x").limit(k)


def correlation_lower(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return correlations(df, [(a, b) for i, a in enumerate(columns) for b in columns[:i]])


def pivot_counts(df: DataFrame, rows: str, columns: str, values: Sequence, counted: str) -> DataFrame:
    """Counts with one column per listed value; a pair that never occurs stays NULL."""
    kept = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    return kept.groupBy(rows).pivot(columns, list(values)).agg(F.count(counted))


def deviations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    row = df.agg(*[F.stddev_samp(no_nan(c)).alias(c) for c in columns])
    return long_row(row, columns, "column_name", "std")
