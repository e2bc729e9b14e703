"""Listing and detail pages to product rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise import fixed_values as fx
from shelfwise.functions import dom
from shelfwise.functions import headphone as hp
from shelfwise.functions import markup as mk
from shelfwise.functions import text as tx
from shelfwise.functions.urls import absolute_url, is_product_url


@dataclass(frozen=True)
class Named:
    """Elements by tag name or by class."""

    tags: tuple[str, ...] = ()
    classes: tuple[str, ...] = ()

    def __call__(self, found: Column, node: Column) -> Column:
        return node["name"].isin(list(self.tags)) | dom.has_class(dom.tag_of(found, node), *self.classes)


@dataclass(frozen=True)
class CardLayout:
    """The elements that are a shop's product cards, and those inside that show name and price."""

    card: Named
    name: Named
    price: Named


# Card markup of the two shops with product cards.
BLOCK_LAYOUT = CardLayout(
    card=Named(classes=("proloop-block",)),
    name=Named(("h3", "h2"), ("proloop-name", "product-name", "product-title")),
    price=Named(classes=("proloop-price--highlight", "product-price", "price", "product__price", "pro-price")),
)
CARD_LAYOUT = CardLayout(
    card=Named(classes=("product-card", "css-1p8n9i2", "css-13l3l78")),
    name=Named(("h3", "h4"), ("css-1xdyrhj", "css-1ehqh5q")),
    price=Named(classes=("att-product-detail-latest-price", "css-1u04k9e", "css-13k0vsy", "css-1b0tqk2")),
)
# Classes of price elements near a product link, and how many ancestors of the link are searched.
LINK_PRICE = "(?i)price|gia|amount"
ANCESTORS = 6
# Price elements of a detail page, the best first: (class of an ancestor, tag, class, class as a whole word).
DETAIL_PRICES = [
    ("product-info", None, "price", False),
    ("product-detail", None, "price", False),
    (None, None, "p-price", True),
    (None, None, "product-price", True),
    (None, None, "price", False),
    (None, "span", "price", True),
    (None, "div", "price", True),
]
PLAIN_PRICE_ABOVE = 10_000
NAME_LENGTH = 300


def _row(source: str, url: Column, name: Column, price: Column) -> list[Column]:
    raw = F.coalesce(tx.price_fragment(price), price, F.lit(""))
    return [
        F.lit(source).alias("source"),
        url.alias("url"),
        F.coalesce(tx.shorten(name, NAME_LENGTH), F.lit("")).alias("name"),
        raw.alias("price_raw"),
        tx.price_or_zero(raw).alias("price_vnd"),
    ]


def listing_rows_from_links(
    pages: DataFrame, source: str, base: str, host: str, html: str = "html", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Product rows of pages where a product is a link near a heading.

    The first link to a product counts. Its card is the nearest of six ancestors that holds a heading (h3
    before h2), which names the product; without one the link's own text does. The price is the first text with a
    digit among the card's price elements (beyond six ancestors: among the seventh's), else the last one's, else
    the link's text.
    """

    def cards(found: Column, nodes: Column) -> Column:
        def climb(state: Column, _: Column) -> Column:
            def look(node: Column) -> Column:
                head = F.coalesce(node["h3"], node["h2"])
                return F.struct(F.when(head.isNotNull(), state["at"]).otherwise(node["parent"]).alias("at"), head.alias("head"))

            stay = state["head"].isNotNull() | (state["at"] < 0)
            return F.when(stay, state).otherwise(look(F.get(nodes, state["at"])))

        def row(link: Column, card: Column) -> Column:
            inside = dom.inside(nodes, F.get(nodes, F.greatest(card["at"], F.lit(0))))
            shown = F.filter(inside, lambda x: dom.tag_of(found, x).rlike("(?i)class") & dom.attribute(dom.tag_of(found, x), "class").rlike(LINK_PRICE))
            prices = F.when(card["at"] >= 0, shown).otherwise(F.slice(nodes, 1, 0))
            texts = F.transform(F.concat(F.array(link, F.get(nodes, F.coalesce(card["head"], F.lit(-1)))), prices), lambda x: mk.text_of(found, x))

            def named(text: Column) -> Column:
                own, rest = F.get(text, F.lit(0)), F.slice(text, F.lit(3), F.size(text))
                price = F.coalesce(F.get(F.filter(rest, lambda t: t.rlike(r"\d")), F.lit(0)), tx.some(F.try_element_at(rest, F.lit(-1))), own)
                return F.struct(F.coalesce(tx.some(F.get(text, F.lit(1))), own).alias("name"), price.alias("price"))

            return tx.let(texts, named)

        def told(link: Column) -> Column:
            start = F.struct(link["node"]["parent"].alias("at"), F.lit(None).cast("int").alias("head"))
            card = F.aggregate(F.sequence(F.lit(1), F.lit(ANCESTORS)), start, climb)
            return F.struct(link["url"].alias("url"), tx.let(card, lambda c: row(link["node"], c)).alias("told"))

        anchors = F.filter(nodes, lambda x: x["name"] == "a")
        linked = F.transform(anchors, lambda x: F.struct(x.alias("node"), absolute_url(base, mk.href(dom.tag_of(found, x))).alias("url")))
        return tx.let(
            F.filter(linked, lambda x: is_product_url(x["url"], host)),
            lambda links: tx.let(
                F.transform(links, lambda x: x["url"]),
                lambda urls: F.transform(F.filter(links, lambda x, i: F.array_position(urls, x["url"]) == i + 1), told),
            ),
        )

    read = pages.select(*keep, F.inline(dom.on_page(html, cards)))
    return read.select(*keep, *_row(source, F.col("url"), F.col("told.name"), F.col("told.price")))


def listing_rows_from_cards(
    pages: DataFrame, source: str, base: str, layout: CardLayout, html: str = "html", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Product rows of pages made of product cards, with the traits their names tell."""

    def cards(found: Column, nodes: Column) -> Column:
        def first(inside: Column, wanted) -> Column:
            return F.get(F.filter(inside, lambda x: wanted(found, x)), F.lit(0))

        def told(inside: Column) -> Column:
            link = first(inside, lambda t, x: (x["name"] == "a") & (dom.attribute(dom.tag_of(t, x), "href") != ""))
            shown = F.array(link, first(inside, layout.name), first(inside, layout.price))
            told = tx.let(shown, lambda s: F.struct(s.alias("s"), F.transform(s, lambda x: mk.text_of(found, x)).alias("t")))
            return tx.let(
                told,
                lambda x: F.struct(
                    F.when(F.get(x["s"], F.lit(0)).isNotNull(), mk.href(dom.tag_of(found, F.get(x["s"], F.lit(0))))).alias("href"),
                    F.coalesce(F.get(x["t"], F.lit(1)), F.get(x["t"], F.lit(0))).alias("name"),
                    F.get(x["t"], F.lit(2)).alias("price"),
                ),
            )

        heads = F.filter(nodes, lambda x: layout.card(found, x))
        return F.transform(heads, lambda h: tx.let(dom.inside(nodes, h), told))

    read = pages.select(*keep, F.inline(dom.on_page(html, cards)))
    rows = read.where(F.col("href").isNotNull()).select(*keep, *_row(source, absolute_url(base, F.col("href")), F.col("name"), F.col("price")))
    return rows.withColumns({"brand": hp.brand_guess("name"), **hp.name_traits("name", "other")})


def detail_price(html: str, lines: Column | str) -> Column:
    """STRUCT<raw, vnd> of a column of detail pages: price elements by the rank of their rule, then any plausible number.

    Of one rule's elements, in page order, the first price above the least plain one counts, else the last; a rule
    whose price is zero leaves the choice to the next.
    """

    def ranked(found: Column, nodes: Column) -> Column:
        def priced(x: Column) -> Column:
            return tx.let(
                mk.text_of(found, x),
                lambda t: F.struct(
                    x["o"].alias("o"),
                    x["name"].alias("name"),
                    dom.attribute(dom.tag_of(found, x), "class").alias("classes"),
                    t.rlike(r"\d{2,}").alias("told"),
                    tx.price_fragment(t).alias("raw"),
                    tx.price_or_zero(tx.price_fragment(t)).alias("vnd"),
                ),
            )

        candidates = F.filter(nodes, lambda x: dom.tag_of(found, x).rlike(r"(?i:class)[^>]*price"))
        tried = F.filter(F.transform(candidates, priced), lambda p: p["told"] & p["classes"].contains("price"))

        def chosen(prices: Column, above: str | None, tag: str | None, word: str, whole: bool) -> Column:
            own = prices
            if above:
                scopes = F.filter(nodes, lambda x: dom.has_class(dom.tag_of(found, x), above))
                own = F.filter(own, lambda p: F.exists(scopes, lambda s: (p["o"] > s["o"]) & (p["o"] <= s["o"] + s["size"])))
            if tag:
                own = F.filter(own, lambda p: p["name"] == tag)
            if whole:
                own = F.filter(own, lambda p: p["classes"].rlike(rf"(?:^|\s){word}(?:\s|$)"))
            best = tx.let(
                own,
                lambda o: F.coalesce(F.get(F.filter(o, lambda p: p["vnd"] > PLAIN_PRICE_ABOVE), F.lit(0)), F.try_element_at(o, F.lit(-1))),
            )
            return tx.let(best, lambda p: F.when(p["vnd"] > 0, F.struct(p["raw"].alias("raw"), p["vnd"].alias("vnd"))))

        return tx.let(
            tried, lambda prices: F.when(F.size(prices) > 0, F.coalesce(*[chosen(prices, *rule) for rule in DETAIL_PRICES]))
        )

    text = F.array_join(tx.col(lines), " ")
    # A page without the word needs no walk.
    by_rule = F.when(F.col(html).contains("price"), dom.on_page(html, ranked))
    return F.coalesce(by_rule, F.get(mk.plausible_prices(text, *fx.PAGE_PRICE_RANGE), F.lit(0)))


def detail_specs(pages: DataFrame, first_shop: bool = False, html: str = "html") -> DataFrame:
    """(url, page_raw, page_vnd, four spec fields) per detail page."""
    labels = fx.PAGE_LABELS_FIRST_SHOP if first_shop else fx.PAGE_LABELS
    brands = fx.PAGE_BRANDS_FIRST_SHOP if first_shop else fx.PAGE_BRANDS
    read = pages.select("url", html, mk.visible_lines(html).alias("_lines"))
    fields = mk.page_specs("_lines", labels, brands)
    return read.select(
        "url",
        detail_price(html, "_lines").alias("_price"),
        *[c.alias(f"page_{n}") for n, c in fields.items()],
    ).select("*", F.col("_price.raw").alias("page_raw"), F.col("_price.vnd").alias("page_vnd")).drop("_price")


SPEC_FIELDS = ["brand", "connection", "battery_life_hours", "weight_gram"]


def merge_details(rows: DataFrame, details: DataFrame, overwrite_empty: bool) -> DataFrame:
    """Detail pages over listing rows.

    ``overwrite_empty`` is the first shop's rule: only rows without a price are visited,
    and there every field is replaced, then the name's traits. Otherwise a page only
    replaces what it tells. Rows without a page stay as they are.
    """
    base = rows
    for n, kind in zip(SPEC_FIELDS, ["string", "string", "bigint", "double"]):
        if n not in base.columns:
            base = base.withColumn(n, F.lit(None).cast(kind))
    names = base.columns
    # Copies of a page must not repeat its product: of several readings the greatest counts.
    told_once = details.groupBy("url").agg(F.max(F.struct(*[c for c in details.columns if c != "url"])).alias("_told"))
    joined = base.join(told_once.select("url", "_told.*", F.lit(True).alias("_page")), "url", "left")
    visited = F.coalesce(F.col("_page"), F.lit(False))
    if not overwrite_empty:
        told = {n: F.coalesce(tx.some(f"page_{n}"), F.col(n)) for n in SPEC_FIELDS[:2]}
        told |= {n: F.coalesce(F.col(f"page_{n}"), F.col(n)) for n in SPEC_FIELDS[2:]}
        return joined.withColumns(told).select(*names)
    visited = visited & (F.coalesce(F.col("price_vnd"), F.lit(0)) == 0)
    changed = {
        "price_raw": F.when(visited, F.coalesce("page_raw", "price_raw")).otherwise(F.col("price_raw")),
        "price_vnd": F.when(visited, F.coalesce("page_vnd", "price_vnd")).otherwise(F.col("price_vnd")),
    }
    changed |= {n: F.when(visited, F.col(f"page_{n}")).otherwise(F.col(n)) for n in SPEC_FIELDS}
    traits = hp.name_traits("name", "first")
    for n, c in traits.items():
        current = F.col(n) if n in names else F.lit(None).cast("string" if n == "type" else "int")
        changed[n] = F.when(visited, c).otherwise(current)
    return joined.withColumns(changed).select(*names, *[n for n in traits if n not in names])
