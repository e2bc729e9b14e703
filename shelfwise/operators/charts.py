"""The tables behind the usual exploratory plots."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.numeric import no_nan
from shelfwise.operators.aggregate import count_by, value_counts
from shelfwise.operators.quantiles import exact_quantiles
from shelfwise.session import attach

WHISKER = 1.5
#: Bandwidths beyond which a Gaussian kernel is zero in double precision: exp(-39 * 39 / 2).
REACH = 39


def value_range(df: DataFrame, column: str) -> tuple[float, float] | None:
    """Smallest and largest present value: one row to the driver."""
    v = no_nan(column)
    row = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).first()
    return None if row["lo"] is None else (row["lo"], row["hi"])


def histogram(
    df: DataFrame, column: str, bins: int, limits: tuple[float, float] | None = None
) -> DataFrame:
    """(bin, low, high, n) of equal-width bins; the last bin is closed, empty bins stay."""
    limits = limits or value_range(df, column) or (0.0, 1.0)
    lo, hi = limits if limits[0] < limits[1] else (limits[0] - 0.5, limits[1] + 0.5)
    step = (hi - lo) / bins

    def edge(i: Column) -> Column:
        return F.when(i == bins, F.lit(hi)).otherwise(F.lit(lo) + i * F.lit(step))

    # The division can land one bin off an edge, so the edges themselves decide.
    guess = F.least(F.floor((F.col("_v") - lo) / F.lit(hi - lo) * bins), F.lit(bins - 1))
    rows = (
        df.select(no_nan(column).alias("_v"))
        .where(F.col("_v").between(lo, hi))
        .withColumn("_g", guess)
        .select(
            F.when(F.col("_v") < edge(F.col("_g")), F.col("_g") - 1)
            .when((F.col("_v") >= edge(F.col("_g") + 1)) & (F.col("_g") < bins - 1), F.col("_g") + 1)
            .otherwise(F.col("_g"))
            .alias("bin")
        )
    )
    counts = rows.groupBy("bin").agg(F.count("*").alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    return frame.join(counts, "bin", "left").select(
        "bin",
        edge(F.col("bin")).alias("low"),
        edge(F.col("bin") + 1).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def automatic_bins(df: DataFrame, column: str) -> int:
    """Bin count whose width is the smaller of the Freedman-Diaconis and Sturges widths."""
    row = exact_quantiles(df, [column], [0.0, 0.25, 0.75, 1.0]).first()
    if row is None or row["q0"] == row["q3"]:
        return 1
    spread = row["q3"] - row["q0"]
    sturges = spread / (math.log2(row["n"]) + 1)
    freedman = 2 * (row["q2"] - row["q1"]) / row["n"] ** (1 / 3)
    return math.ceil(spread / (min(sturges, freedman) if freedman > 0 else sturges))


def automatic_histogram(df: DataFrame, column: str) -> DataFrame:
    return histogram(df, column, automatic_bins(df, column))


def density(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth on a grid over the data range.

    A value meets only the grid points within ``REACH`` bandwidths, beyond which its kernel is zero
    in double precision; what it adds is summed inside its own task first, so the shuffle carries
    ``points`` rows per task, whatever the input size.
    """
    v = no_nan(column)
    row = df.agg(
        F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"), F.stddev_samp(v).alias("sd")
    ).first()
    if not row["sd"]:
        return df.sparkSession.createDataFrame([], "point long, x double, density double")
    width = row["sd"] * row["n"] ** -0.2
    step = (row["hi"] - row["lo"]) / (points - 1)
    place = F.lit(row["lo"]) + F.col("point") * F.lit(step)
    z = (F.col("_v") - place) / F.lit(width)
    reach = REACH * width
    low = F.greatest(F.lit(0), F.ceil((F.col("_v") - F.lit(row["lo"] + reach)) / F.lit(step)).cast("int"))
    high = F.least(F.lit(points - 1), F.floor((F.col("_v") - F.lit(row["lo"] - reach)) / F.lit(step)).cast("int"))
    scale = row["n"] * width * math.sqrt(2 * math.pi)
    near = (
        df.select(v.alias("_v"))
        .where(F.col("_v").isNotNull())
        .select("_v", low.alias("_low"), high.alias("_high"))
        .where("_low <= _high")
        .select("_v", F.explode(F.sequence("_low", "_high")).alias("point"))
    )
    # Grouping by the bare point number keeps the in-task sums in a fast integer hash map.
    mass = near.groupBy("point").agg(F.sum(F.exp(-z * z / 2)).alias("mass"))
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
    return grid.join(mass, "point", "left").select(
        F.col("point").cast("long").alias("point"),
        place.alias("x"),
        (F.coalesce("mass", F.lit(0.0)) / F.lit(scale)).alias("density"),
    )


def before_after(before: DataFrame, after: DataFrame, column: str, bins: int) -> DataFrame:
    """Both histograms over the range of the first frame, tagged with their stage."""
    limits = value_range(before, column)
    return (
        histogram(before, column, bins, limits)
        .withColumn("stage", F.lit("before"))
        .unionByName(histogram(after, column, bins, limits).withColumn("stage", F.lit("after")))
    )


def fences(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Quartiles and outlier fences, one row per group."""
    box = exact_quantiles(df, [column], [0.25, 0.5, 0.75], by)
    reach = WHISKER * (F.col("q2") - F.col("q0"))
    return box.select(
        *by,
        F.col("q0").alias("q1"),
        F.col("q1").alias("median"),
        F.col("q2").alias("q3"),
        (F.col("q0") - reach).alias("low_fence"),
        (F.col("q2") + reach).alias("high_fence"),
    )


def _fenced(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    rows = df.where(no_nan(column).isNotNull())
    for key in by:
        rows = rows.where(F.col(key).isNotNull())
    if by:
        return attach(rows, fences(df, column, by), list(by), "inner")
    row = fences(df, column).first()
    names = ["q1", "median", "q3", "low_fence", "high_fence"]
    return rows.withColumns({n: F.lit(row[n] if row else None).cast("double") for n in names})


def box_stats(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whiskers (furthest points inside the fences) and outlier count per group."""
    v = no_nan(column)
    inside = v.between(F.col("low_fence"), F.col("high_fence"))
    return _fenced(df, column, by).groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(inside, v)).alias("low_whisker"),
        F.max(F.when(inside, v)).alias("high_whisker"),
        F.count_if(~inside).alias("n_outliers"),
        F.count("*").alias("n"),
    )


def outliers(df: DataFrame, column: str, by: Sequence[str] = (), show: bool = True) -> DataFrame:
    """The rows outside the fences of their group; none when hidden."""
    v = no_nan(column)
    rows = _fenced(df, column, by).where(~v.between(F.col("low_fence"), F.col("high_fence")))
    return rows.select(*df.columns) if show else rows.select(*df.columns).where(F.lit(False))


def linear_fits(df: DataFrame, pairs: Sequence[tuple[str, str]], by: Sequence[str] = ()) -> DataFrame:
    """Least-squares y = slope * x + intercept per pair and group; missing pairs are skipped."""
    cells = []
    for x, y in pairs:
        both = no_nan(x).isNotNull() & no_nan(y).isNotNull()
        a, b = F.when(both, no_nan(x)), F.when(both, no_nan(y))
        cells.append(
            F.struct(
                F.lit(x).alias("x"),
                F.lit(y).alias("y"),
                F.regr_slope(b, a).alias("slope"),
                F.regr_intercept(b, a).alias("intercept"),
                F.regr_r2(b, a).alias("r2"),
                F.regr_count(b, a).alias("n"),
            )
        )
    return df.groupBy(*by).agg(F.array(*cells).alias("m")).select(*by, F.inline("m"))


def scatter(
    df: DataFrame, x: str, y: str, keep: Sequence[str] = (), share: float | None = None, key: str | None = None
) -> DataFrame:
    """(x, y) pairs of rows that have both; ``share`` thins by a hash of the key for display."""
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    if share is not None:
        slot = F.pmod(F.xxhash64(key or F.struct(*df.columns)), F.lit(1_000_000))
        rows = rows.where(slot < int(share * 1_000_000))
    return rows.select(*keep, F.col(x).alias("x"), F.col(y).alias("y"))


def bars(df: DataFrame, column: str, n: int) -> DataFrame:
    return value_counts(df, column).limit(n)


def series(df: DataFrame, key: str, counted: str) -> DataFrame:
    """Counts in key order; keys without rows stay absent."""
    return count_by(df, [key], counted).orderBy(key)
