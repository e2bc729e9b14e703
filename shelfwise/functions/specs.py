"""Nested product specifications: ARRAY<STRUCT<category, details MAP<STRING, STRING>>>."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.fixed_values import DEFAULT_SPEC_CATEGORY
from shelfwise.functions.text import cell_value, col, first_present, let, strip

ENTRIES = "array<struct<key:string,value:string>>"


def list_as_text(value: Column | str) -> Column:
    """A JSON list becomes its items joined by ' | '; other text stays."""
    text = col(value)
    listed = F.array_join(F.from_json(text, "array<string>"), " | ")
    return F.when(text.startswith("["), F.coalesce(listed, text)).otherwise(text)


def last_wins(entries: Column) -> Column:
    """Entries to a map; a repeated key keeps its last value."""

    def kept(back: Column, names: Column) -> Column:
        return F.map_from_entries(
            F.filter(back, lambda e, i: F.array_position(names, e["key"]) == i + 1)
        )

    return let(
        F.reverse(entries), lambda back: let(F.transform(back, lambda e: e["key"]), lambda names: kept(back, names))
    )


def merged_specs(specifications: Column | str) -> Column:
    """All details of a product in one map: keys lower-cased, lists joined, last key wins."""
    maps = F.transform(col(specifications), lambda s: F.map_entries(s["details"]))
    entries = F.transform(
        F.flatten(F.filter(maps, lambda m: m.isNotNull())),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), list_as_text(e["value"]).alias("value")),
    )
    return last_wins(F.coalesce(entries, F.array().cast(ENTRIES)))


def lookup(specs: Column | str, labels: Sequence[str]) -> Column:
    """Value of the first label that is present and not empty."""
    return first_present(*[F.try_element_at(col(specs), F.lit(label)) for label in labels])


def details_from_rows(cells: Column) -> Column:
    """(key, value) cell pairs to one details map; colons after labels are dropped."""
    pairs = F.transform(
        cells,
        lambda c: F.struct(
            F.rtrim(strip(c["key"]), F.lit(":")).alias("key"), cell_value(c["value"]).alias("value")
        ),
    )
    return last_wins(pairs)


def grouped_rows(rows: Column | str) -> Column:
    """A stream of table rows to [{category, details}].

    ``rows`` is ARRAY<STRUCT<key, value>>; a row with NULL value opens a category. The
    array belongs to one page, so the work stays inside the record and needs no shuffle.
    """
    opening = F.struct(F.lit(DEFAULT_SPEC_CATEGORY).alias("key"), F.lit(None).cast("string").alias("value"))

    def sections(full: Column, heads: Column) -> Column:
        def section(head: Column, k: Column) -> Column:
            stop = F.coalesce(F.get(heads, k + 1), F.size(full))
            return F.struct(
                strip(F.get(full, head)["key"]).alias("category"),
                details_from_rows(F.slice(full, head + 2, stop - head - 1)).alias("details"),
            )

        return F.filter(F.transform(heads, section), lambda s: F.size(s["details"]) > 0)

    def with_heads(full: Column) -> Column:
        marked = F.transform(full, lambda r, i: F.when(r["value"].isNull(), i))
        return let(F.array_compact(marked), lambda heads: sections(full, heads))

    return let(F.concat(F.array(opening), col(rows)), with_heads)


def usable_specs(specifications: Column | str) -> Column:
    """Failed records hold no list of specifications; they read as an empty one."""
    return F.coalesce(
        col(specifications),
        F.array().cast("array<struct<category:string,details:map<string,string>>>"),
    )
