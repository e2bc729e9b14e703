"""Filling missing values from constants, other columns and group statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.quantiles import exact_quantiles, wide_medians, wide_modes
from shelfwise.session import attach, one_row


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.na.fill({c: v for c, v in values.items() if c in df.columns})


def fill_from_column(df: DataFrame, target: str, replacement: Column) -> DataFrame:
    return df.withColumn(target, F.coalesce(F.col(target), replacement))


def median_of(df: DataFrame, column: str) -> Column:
    return one_row(exact_quantiles(df, [column], [0.5]).select("q0"))["q0"]


def fill_median(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), median_of(df, column)))


def quantile_bands(
    df: DataFrame, column: str, labels: Sequence[str], into: str, merge_equal: bool = False
) -> DataFrame:
    """Equal-count bands: interpolated edges, right-closed, lowest value included.

    Equal neighbouring edges leave bands between them without values. That is an error, unless
    ``merge_equal`` says that a value on equal edges takes the first of their bands.
    """
    k = len(labels)
    value = F.col(column).cast("double")
    edges = one_row(exact_quantiles(df, [column], [i / k for i in range(k + 1)]))
    distinct = F.lit(True)
    for i in range(0 if merge_equal else k):
        distinct = distinct & (edges[f"q{i}"] < edges[f"q{i + 1}"])
    chain = F.when(value.isNull(), F.lit(None)).when(
        ~distinct, F.raise_error(F.lit(f"band edges of {column} are not unique")).cast("string")
    )
    for i, label in enumerate(labels[:-1]):
        chain = chain.when(value <= edges[f"q{i + 1}"], F.lit(label))
    return df.withColumn(into, chain.otherwise(F.lit(labels[-1])))


def fill_group_medians(
    df: DataFrame, by: str, columns: Sequence[str], min_values: int = 1
) -> DataFrame:
    """Group median where the group has enough values, then the median of the filled column.

    All columns share one pass for the group statistics and one for the overall ones.
    """
    order = df.columns
    stats = wide_medians(df, columns, [by])
    joined = attach(df, stats, [by], "left")
    filled = joined.withColumns(
        {
            c: F.coalesce(
                F.col(c).cast("double"), F.when(F.col(f"n_{c}") >= min_values, F.col(f"med_{c}"))
            )
            for c in columns
        }
    ).select(*order)
    left = _still_missing(filled, columns)
    if not left:
        return filled
    overall = one_row(wide_medians(filled, left))
    return filled.withColumns({c: F.coalesce(F.col(c), overall[f"med_{c}"]) for c in left})


def fill_group_modes(
    df: DataFrame, by: str, columns: Sequence[str], default: str = "Unknown"
) -> DataFrame:
    """Group mode, a default where the group has none; rows without a group take the overall mode."""
    order = df.columns
    joined = attach(df, wide_modes(df, columns, [by]), [by], "left")
    grouped = F.col(by).isNotNull()
    filled = joined.withColumns(
        {
            c: F.coalesce(F.col(c), F.col(f"mode_{c}"), F.when(grouped, F.lit(default)))
            for c in columns
        }
    ).select(*order)
    left = _still_missing(filled, columns)
    if not left:
        return filled
    overall = one_row(wide_modes(filled, left))
    return filled.withColumns(
        {c: F.coalesce(F.col(c), overall[f"mode_{c}"], F.lit(default)) for c in left}
    )


def _still_missing(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns that still miss values: one cheap pass that mostly saves the costlier one."""
    row = df.agg(*[F.count_if(F.isnull(c)).alias(c) for c in columns]).first()
    return [c for c in columns if row[c]]
