"""Sinks. Parquet is the hand-off between stages; these are the exchange formats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.fixed_values import HEADPHONE_COLUMNS
from shelfwise.sources.readers import LINK_COLUMN


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, escape='"', encoding="UTF-8")


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, UTF-8, one record per line."""
    df.write.mode("overwrite").json(path, encoding="UTF-8")


def fixed_columns(df: DataFrame, names: Sequence[str] = HEADPHONE_COLUMNS) -> DataFrame:
    """Exactly the named columns: extra ones dropped, absent ones NULL."""
    return df.select(
        *[F.col(n) if n in df.columns else F.lit(None).cast("string").alias(n) for n in names]
    )


def write_fixed(df: DataFrame, path: str, names: Sequence[str] = HEADPHONE_COLUMNS) -> None:
    write_csv(fixed_columns(df, names), path)


def write_links(df: DataFrame, url: Column | str, path: str) -> None:
    column = F.col(url) if isinstance(url, str) else url
    write_csv(df.select(column.alias(LINK_COLUMN)), path)
