"""Text expressions shared by every extractor.

Patterns run with Unicode classes and Unicode case folding, so ``\\w`` and ``\\b`` see
accented letters. A pattern that misses gives NULL, never ''.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNICODE = "(?U)"
UNICODE_NOCASE = "(?iU)"

#: Every character that counts as white space, for trimming. Inside a pattern, ``\\s`` with the
#: Unicode flag is several times faster than listing these.
WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def some(c: Column | str) -> Column:
    """'' counts as absent."""
    return F.nullif(col(c), F.lit(""))


def first_present(*columns: Column | str) -> Column:
    return F.coalesce(*[some(c) for c in columns])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    Expressions inside array functions are not shared by the optimizer: without this, a
    value used twice in a lambda is computed twice for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(WHITESPACE))


def squeeze(c: Column | str) -> Column:
    return strip(F.regexp_replace(col(c), UNICODE + r"\s+", " "))


def extract(c: Column | str, pattern: str, group: int = 1, ignore_case: bool = True) -> Column:
    return some(F.regexp_extract(col(c), (UNICODE_NOCASE if ignore_case else UNICODE) + pattern, group))


def matches(c: Column | str, pattern: str) -> Column:
    return F.coalesce(col(c).rlike(UNICODE_NOCASE + pattern), F.lit(False))


def first_match(c: Column | str, patterns: Sequence[str]) -> Column:
    """Group 1 of the first pattern that matches, stripped."""
    return F.coalesce(*[strip(extract(c, p)) for p in patterns])


def digit_runs(c: Column | str) -> Column:
    return F.regexp_extract_all(col(c), F.lit(r"(\d+)"), F.lit(1))


def flag(c: Column | str, pattern: str) -> Column:
    """1 when the lower-cased text holds the pattern, else 0 (also for NULL)."""
    return F.coalesce(F.lower(col(c)).rlike(pattern), F.lit(False)).cast("int")


def before_colon(c: Column | str) -> Column:
    return F.split_part(col(c), F.lit(":"), F.lit(1))


def clean_name(c: Column | str) -> Column:
    """Without (…) and […], whitespace collapsed."""
    bare = F.regexp_replace(col(c), r"\([^)]*\)", "")
    return squeeze(F.regexp_replace(bare, r"\[[^\]]*\]", ""))


def clean_chipset(c: Column | str) -> Column:
    """Without (…) and punctuation, whitespace collapsed."""
    bare = F.regexp_replace(col(c), r"\([^)]*\)", "")
    return squeeze(F.regexp_replace(bare, UNICODE + r"[^\w\s]+", ""))


def label_key(c: Column | str) -> Column:
    """A spec label: trimmed, trailing colons removed, lower-cased."""
    return F.lower(F.rtrim(strip(c), F.lit(":")))


def shorten(c: Column | str, length: int = 300) -> Column:
    return F.substring(col(c), 1, length)


def non_blank_lines(c: Column | str) -> Column:
    """The stripped, non-empty lines of a text as an array."""
    lines = F.transform(F.split(col(c), r"\r\n|\n|\r"), strip)
    return F.filter(lines, lambda x: x != "")


def cell_value(c: Column | str) -> Column:
    """A table cell: several lines become items joined by ' | ', one line stays as is."""
    text = strip(c)
    return F.when(text.contains("\n"), F.array_join(non_blank_lines(text), " | ")).otherwise(text)


def price_digits(c: Column | str) -> Column:
    """First run of digits, dots and commas as an integer; no such run gives NULL."""
    run = extract(c, r"([\d.,]+)")
    return F.regexp_replace(run, "[.,]", "").try_cast("long")


def price_or_zero(c: Column | str) -> Column:
    """Separators, currency signs and blanks removed, then the first digit run; else 0."""
    joined = F.translate(col(c), ".,₫đ ", "")
    return F.coalesce(extract(joined, r"(\d+)").try_cast("long"), F.lit(0).cast("long"))


def price_fragment(c: Column | str) -> Column:
    """The first price-looking piece of a longer text."""
    return strip(extract(c, r"[\d.,]+\s*[đ₫]?", 0))
