"""Listing and detail pages of several shops to one headphone table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfwise.operators import pages as pg
from shelfwise.operators import rows
from shelfwise.sources.writers import fixed_columns


def product_rows(
    listings: DataFrame, details: DataFrame, first_shop: bool, order: list[str], max_items: int | None = None
) -> DataFrame:
    """First listing row per address, completed from its detail page, in the thirteen columns.

    ``max_items`` keeps the first products only, where a crawl was meant to stop.
    """
    named = listings.where("trim(url) <> ''")
    first = rows.keep_first(named, ["url"], order)
    if max_items is not None:
        first = rows.top_rows(first, [*order, "url"], max_items)
    told = pg.detail_specs(details, first_shop=first_shop)
    return fixed_columns(pg.merge_details(first.drop(*order), told, overwrite_empty=first_shop))
