"""Number, band and calendar expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.text import digit_runs, extract, strip

PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def no_nan(c: Column | str) -> Column:
    """NaN and NULL are one kind of missing; casting first lets any number in."""
    value = col(c).cast("double")
    return F.when(~F.isnan(value), value)


def to_number(c: Column | str) -> Column:
    """Text to double; text that is not a plain number becomes NULL."""
    text = col(c).cast("string")
    return F.when(text.rlike(PLAIN_NUMBER), strip(text).try_cast("double"))


def truncate(c: Column | str) -> Column:
    return col(c).try_cast("long")


def ratio_in_millions(amount: Column | str, per: Column | str) -> Column:
    return col(amount).cast("double") / F.lit(1e6) / F.nullif(col(per).cast("double"), F.lit(0.0))


def band(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first edge above the value, else the last label; NULL stays NULL."""
    value = col(c)
    chain = F.when(value.isNull(), F.lit(None))
    for edge, label in zip(edges, labels):
        chain = chain.when(value < edge, F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def round_half_even(c: Column | str, places: int) -> Column:
    """Scale, round halves to even, scale back: the rounding of float arrays."""
    scale = float(10**places)
    return F.rint(col(c).cast("double") * scale) / scale


def scaled(c: Column | str, factor: float) -> Column:
    return col(c).cast("double") * factor


def grams(c: Column | str) -> Column:
    """Weight text to grams. The decimal comma is accepted; other units give NULL."""
    return to_number(extract(F.replace(col(c), F.lit(","), F.lit(".")), r"([\d.,]+)\s*g"))


def largest_integer(c: Column | str) -> Column:
    return F.array_max(F.transform(digit_runs(c), lambda x: x.try_cast("long")))


def clock_text(seconds: Column | str) -> Column:
    """Seconds as HH:MM:SS; fractions are cut and negatives count as zero."""
    whole = F.greatest(col(seconds).try_cast("long"), F.lit(0))
    return F.format_string(
        "%02d:%02d:%02d", F.expr("1") * F.floor(whole / 3600), F.floor(whole % 3600 / 60), whole % 60
    )


def parse_timestamp(c: Column | str, lenient: bool = False) -> Column:
    """'YYYY-MM-DD HH:MM:SS' to a timestamp without zone; bad text is an error, or NULL if lenient."""
    if lenient:
        return col(c).try_cast("timestamp_ntz")
    return F.to_timestamp_ntz(col(c), F.lit("yyyy-MM-dd HH:mm:ss"))


# Short weekday names, Monday first.
WEEKDAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def weekday_name(c: Column | str) -> Column:
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    return F.element_at(names, F.weekday(col(c)) + 1)
