"""The emergency-call calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.numeric import parse_timestamp, weekday_name
from shelfwise.functions.text import before_colon
from shelfwise.operators import aggregate as agg
from shelfwise.operators import charts
from shelfwise.operators.rows import union_by_name
from shelfwise.session import cut_lineage

TOP = 5


def with_calendar(calls: DataFrame) -> DataFrame:
    """Adds reason, hour, month, weekday and day to rows with title and timeStamp text."""
    when = parse_timestamp("timeStamp")
    return calls.withColumns(
        {
            "reason": before_colon("title"),
            "hour": F.hour(when),
            "month": F.month(when),
            "weekday": weekday_name(when),
            "day": F.to_date(when).cast("string"),
        }
    )


def calendar_cube(calls: DataFrame) -> DataFrame:
    """Calls per reason and hour of each day, stored once.

    Its size grows with days, hours and reasons, not with calls; every calendar view is
    summed from it, so the calls themselves are read a single time for all of them.
    """
    keys = ["reason", "day", "weekday", "month", "hour"]
    counts = with_calendar(calls).groupBy(*keys).agg(F.count("*").alias("calls"), F.count("twp").alias("placed"))
    return cut_lineage(counts)


def call_calendar(calls: DataFrame) -> DataFrame:
    """All views of the calendar as (view, key_1, key_2, n)."""
    cube = calendar_cube(calls)

    def view(name: str, first: str, second: str | None = None, measure: str = "calls") -> DataFrame:
        keys = [first, *([second] if second else [])]
        sums = cube.dropna(subset=keys).groupBy(*keys).agg(F.sum(measure).alias("n"))
        return _view(sums, name, first, second)

    return union_by_name(
        [
            _view(agg.top_values(calls, "zip", TOP), "top_zip", "value"),
            _view(agg.top_values(calls, "twp", TOP), "top_township", "value"),
            calls.agg(F.count_distinct("title").alias("n")).select(
                F.lit("distinct_titles").alias("view"),
                F.lit(None).cast("string").alias("key_1"),
                F.lit(None).cast("string").alias("key_2"),
                "n",
            ),
            view("reason", "reason"),
            view("weekday_reason", "weekday", "reason"),
            view("month_reason", "month", "reason"),
            view("month", "month", measure="placed"),
            view("day", "day", measure="placed"),
            view("day_reason", "day", "reason", measure="placed"),
            view("weekday_hour", "weekday", "hour"),
            view("weekday_month", "weekday", "month"),
        ]
    )


def _view(df: DataFrame, name: str, first: str, second: str | None = None) -> DataFrame:
    return df.select(
        F.lit(name).alias("view"),
        F.col(first).cast("string").alias("key_1"),
        (F.col(second) if second else F.lit(None)).cast("string").alias("key_2"),
        "n",
    )


def monthly_trend(calls: DataFrame) -> DataFrame:
    """Linear fit of the number of placed calls on the month."""
    months = calendar_cube(calls).groupBy("month").agg(F.sum("placed").alias("placed"))
    return charts.linear_fits(months, [("month", "placed")])
