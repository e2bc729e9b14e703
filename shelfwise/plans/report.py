"""The price-driver report as one long table (section, item, metric, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators import aggregate as agg
from shelfwise.operators import charts, lookup
from shelfwise.operators.rows import union_by_name
from shelfwise.session import cut_lineage


def _long(df: DataFrame, section: str, item: str, metrics: Sequence[str]) -> DataFrame:
    values = [F.col(m).cast("double").alias(m) for m in metrics]
    return df.select(F.lit(section).alias("section"), F.col(item).cast("string").alias("item"), *values).unpivot(
        ["section", "item"], list(metrics), "metric", "value"
    )


def price_report(
    df: DataFrame, price: str, brand: str, numbers: Sequence[str], columns: Sequence[str], top: int = 10
) -> DataFrame:
    """Distinct counts, gaps, description, correlation, brand medians and brand boxes."""
    correlations = agg.correlation_pairs(df, numbers).withColumn("pair", F.concat_ws("~", "x", "y"))
    top_brands = cut_lineage(agg.top_values(df, brand, top))
    boxes = charts.box_stats(lookup.keep_members(df, brand, top_brands), price, [brand])
    return union_by_name(
        [
            _long(agg.distinct_counts(df, columns), "distinct", "column_name", ["n_distinct"]),
            _long(agg.missing_profile(df, columns), "missing", "column_name", ["n_missing", "percent"]),
            _long(
                agg.describe(df, numbers),
                "describe",
                "metric",
                ["n_present", "mean", "std", "min", "p25", "p50", "p75", "max"],
            ),
            _long(correlations, "correlation", "pair", ["r"]),
            _long(agg.ranked_group_medians(df, brand, price, 15), "brand_median", brand, ["median_value"]),
            _long(
                boxes,
                "brand_box",
                brand,
                ["low_whisker", "q1", "median", "q3", "high_whisker", "n_outliers"],
            ),
        ]
    )
