"""Page markup to text, links, table rows and labelled values, inside one record each.

Text and links come from linear patterns, what depends on nesting from the page's elements (``dom``).
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions import dom
from shelfwise.functions import specs as sp
from shelfwise.functions import text as tx
from shelfwise.functions.text import col

TAG = r"<[a-zA-Z/!?][^>]*>"
_ANY_TAG = rf"{dom.TAG}|<[!?][^>]*+>"
#: Group 1: a link tag and all up to </a>, the next <a or the end; other tags match without it, so what their values hold is skipped.
LINK = rf"(?is)(<a(?=[\s/>])(?:[^<>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+>(?:[^<]++|<(?!/?a[\s/>]))*+)|{dom.TAG}"


#: Characters 0x80 to 0x9F of that code page; the five it leaves out stand for themselves.
WINDOWS_1252 = "".join(
    chr(b) if b in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else bytes([b]).decode("windows-1252") for b in range(0x80, 0xA0)
)


#: All public names with what they stand for.
_NAMES = json.dumps({k[:-1]: v for k, v in html5.items() if k.endswith(";")})


def _character(name: Column) -> Column:
    """What a reference (without & and ;) stands for; NULL for a name that is not one."""
    known = F.from_json(F.lit(_NAMES), "map<string, string>")
    hexadecimal = name.rlike("^#[xX]")
    digits = F.regexp_replace(name, "^#[xX]?0*", "")
    # More than seven digits are beyond the last character in either notation.
    number = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10))
    code = F.when(F.length(digits) > 7, F.lit(0x110000)).otherwise(F.coalesce(number.try_cast("int"), F.lit(0)))

    def written(c: Column) -> Column:
        wide = F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32")
        return (
            F.when((c == 0) | c.between(0xD800, 0xDFFF) | (c > 0x10FFFF), F.lit("\ufffd"))
            # Browsers read this range as Windows-1252.
            .when(c.between(0x80, 0x9F), F.substr(F.lit(WINDOWS_1252), c - 0x7F, F.lit(1)))
            .otherwise(wide)
        )

    # The long list is searched from its beginning, so the names of nearly all references come first.
    common = F.when(name == "amp", "&").when(name == "lt", "<").when(name == "gt", ">").when(name == "quot", '"').when(name == "nbsp", "\xa0")
    named = common.otherwise(F.try_element_at(known, name))
    return F.when(name.startswith("#"), tx.let(code, written)).otherwise(named)


def unescape(c: Column | str) -> Column:
    """Character references to characters in one pass from left to right.

    All public names and decimal and hexadecimal numbers, each closed by a semicolon; numbers
    that stand for no character become U+FFFD; anything else stays as it is written.
    """

    def piece(part: Column) -> Column:
        name = F.regexp_extract(part, r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);", 1)
        return F.coalesce(
            F.concat(_character(F.nullif(name, F.lit(""))), F.substr(part, F.length(name) + 2)), F.concat(F.lit("&"), part)
        )

    def decoded(text: Column) -> Column:
        parts = F.split(text, "&", -1)
        return F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), piece), ""))

    return tx.let(col(c), lambda text: F.when(text.contains("&"), decoded(text)).otherwise(text))


def shown(html: Column | str) -> Column:
    """Markup without comments, scripts, styles and doctype."""
    return F.regexp_replace(col(html), dom.HIDDEN, "")


def inline_text(html: Column | str) -> Column:
    """Text of a shown fragment with its tags removed, stripped."""
    return tx.strip(unescape(F.regexp_replace(col(html), _ANY_TAG, "")))


def cell_text(html: Column | str) -> Column:
    """Like inline_text, with a line break per <br> or block end."""
    broken = F.regexp_replace(col(html), r"(?i)<br\s*/?>|</(?:p|div|li)\s*>", "\n")
    return tx.strip(unescape(F.regexp_replace(broken, _ANY_TAG, "")))


def visible_lines(html: Column | str) -> Column:
    """The text nodes of a page, one array item per stripped, non-empty line."""
    return tx.non_blank_lines(unescape(F.regexp_replace(shown(html), TAG, "\n")))


def href(tag: Column | str) -> Column:
    """Address of the link tag that the text begins with; empty without one."""
    return unescape(dom.attribute(tag, "href"))


def links(html: Column | str) -> Column:
    """ARRAY<STRUCT<href, label>> of the links with an address; of a repeated address only the first is kept."""

    def first_of_each(found: Column, hrefs: Column) -> Column:
        return F.filter(found, lambda x, i: F.array_position(hrefs, x["href"]) == i + 1)

    parts = F.filter(F.regexp_extract_all(shown(html), F.lit(LINK), F.lit(1)), lambda x: x.rlike(r"(?i)\shref[\s=]"))
    both = F.transform(parts, lambda x: F.struct(href(x).alias("href"), inline_text(x).alias("label")))
    addressed = F.filter(both, lambda x: x["href"] != "")
    return tx.let(addressed, lambda found: tx.let(F.transform(found, lambda x: x["href"]), lambda hrefs: first_of_each(found, hrefs)))


def text_of(found: Column, node: Column) -> Column:
    """Text of an element of a page's tokens, stripped."""
    return inline_text(dom.markup_of(found, node))


def following_line(lines: Column | str, labels: Sequence[str]) -> Column:
    """The line after the first line that holds any of the labels; NULL without one."""
    pattern = "|".join(label.lower() for label in labels)
    hit = F.array_position(
        F.transform(col(lines), lambda ln: F.lower(ln).rlike(pattern)), F.lit(True)
    )
    # A position counts from 1, so as an index from 0 it names the next line.
    return F.get(col(lines), F.nullif(hit, F.lit(0)).cast("int"))


def plausible_prices(text: Column | str, low: int, high: int) -> Column:
    """Grouped numbers of a text as (raw, vnd) whose value lies in the range, in text order."""
    found = F.regexp_extract_all(
        col(text), F.lit(r"(\d{1,3}(?:\.\d{3}){2,}(?:\s*[đ₫])?)"), F.lit(1)
    )
    priced = F.transform(found, lambda r: F.struct(tx.strip(r).alias("raw"), tx.price_or_zero(r).alias("vnd")))
    return F.filter(priced, lambda p: p["vnd"].between(low, high))


def page_specs(lines: Column | str, labels: dict[str, Sequence[str]], brands: str) -> dict[str, Column]:
    """brand, connection, battery_life_hours and weight_gram told by labelled lines."""
    from shelfwise.functions.numeric import grams, largest_integer

    array = col(lines)
    named = following_line(array, labels["brand"])
    guessed = tx.extract(F.array_join(array, "\n"), f"({brands})")
    return {
        "brand": F.coalesce(named, guessed, F.lit("")),
        "connection": F.coalesce(following_line(array, labels["connection"]), F.lit("")),
        "battery_life_hours": largest_integer(following_line(array, labels["battery"])),
        "weight_gram": grams(following_line(array, labels["weight"])),
    }


def table_rows(found: Column, within: Column) -> Column:
    """ARRAY<STRUCT<key, value>> of the table rows among elements; a one-cell row has no value.

    All cells inside a row count, also those of a table within one of them.
    """

    def row(cells: Column) -> Column:
        def cell(k: int) -> Column:
            return F.when(F.size(cells) > k, cell_text(dom.markup_of(found, F.get(cells, F.lit(k)))))

        return F.struct(cell(0).alias("key"), cell(1).alias("value"))

    pairs = F.transform(
        F.filter(within, lambda x: x["name"] == "tr"),
        lambda r: tx.let(F.filter(dom.inside(within, _shifted(r, within)), lambda c: c["name"].isin("td", "th")), row),
    )
    return F.filter(pairs, lambda p: p["key"].isNotNull())


def _shifted(node: Column, within: Column) -> Column:
    """An element whose index counts from the first of a run of elements."""
    return F.struct((node["o"] - F.get(within, F.lit(0))["o"]).alias("o"), node["size"].alias("size"))


def table_specs(html: str) -> Column:
    """[{category, details}] of a column of pages whose one-cell rows are category titles."""
    return sp.grouped_rows(dom.on_page(html, table_rows))


# Markup of a sectioned specification sheet.
SECTION_CLASS = "technical-content-section"
SECTION_TITLE_TAG, SECTION_TITLE_CLASS = "p", "title"


def sectioned_specs(html: str) -> Column:
    """[{category, details}] of a column of pages with one titled section per category."""

    def section(found: Column, within: Column) -> Column:
        titles = F.filter(within, lambda x: (x["name"] == SECTION_TITLE_TAG) & dom.has_class(dom.tag_of(found, x), SECTION_TITLE_CLASS))
        rows = F.filter(table_rows(found, within), lambda r: r["value"].isNotNull())
        return F.struct(
            tx.let(titles, lambda t: F.when(F.size(t) > 0, text_of(found, F.get(t, F.lit(0))))).alias("category"),
            sp.details_from_rows(rows).alias("details"),
        )

    def sections(found: Column, elements: Column) -> Column:
        heads = F.filter(elements, lambda x: dom.has_class(dom.tag_of(found, x), SECTION_CLASS))
        return F.transform(heads, lambda h: tx.let(dom.inside(elements, h), lambda within: section(found, within)))

    return F.filter(dom.on_page(html, sections), lambda s: F.size(s["details"]) > 0)
