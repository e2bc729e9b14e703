"""Page text (G) and the steps built on it (P16, W8, M5, M6, F32)."""

from html.entities import html5

from pyspark.sql import functions as F

from shelfwise import fixed_values as fx
from shelfwise.functions import markup as mk
from shelfwise.functions.urls import absolute_url
from shelfwise.operators import pages as pg
from shelfwise.operators.rows import union_by_name
from shelfwise.queries import query
from shelfwise.queries.numbers import GRAMS
from shelfwise.queries.sql import strip
from shelfwise.sources.derived import (
    LISTING_SIZE,
    PRODUCT_PATH,
    SHOWN_PRICE,
    detail_pages,
    listing_pages,
    spec_texts_sql,
)
from shelfwise.sources.tables import spread, table, width

TEXTS = spec_texts_sql()


#: Names that the given pages use; SQL has no decoder, so it replaces these one by one.
_NAMES = "nbsp lt gt quot apos copy reg trade middot bull ndash mdash hellip euro times".split()


def unescape_sql(x):
    for name in _NAMES:
        x = f"replace({x}, '&{name};', '{html5[name + ';'].replace(chr(39), chr(39) * 2)}')"
    return f"replace({x}, '&amp;', '&')"


_SHOWN = r"regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!doctype[^>]*>', '', 'g')"
_SPLIT = f"string_split({unescape_sql(f'regexp_replace({_SHOWN}, ' + repr('<[a-zA-Z/!?][^>]*>') + ', chr(10), ' + repr('g') + ')')}, chr(10))"
LINES = f"list_filter(list_transform({_SPLIT}, lambda x: {strip('x')}), lambda x: x <> '')"
_PAGE_LINES = f"(SELECT page_id, url, {LINES} AS lines FROM pages)"


@query(
    "g1_visible_lines",
    f"SELECT page_id, CAST(len(lines) AS INTEGER) AS n_lines, array_to_string(lines, chr(10)) AS body FROM {_PAGE_LINES}",
)
def _(spark, d):
    lines = spread(table(spark, d, "pages"), width(spark)).select("page_id", mk.visible_lines("html").alias("lines"))
    return lines.select("page_id", F.size("lines").alias("n_lines"), F.array_join("lines", "\n").alias("body"))


_LINKS = rf"""(SELECT page_id, unnest(regexp_extract_all({_SHOWN}, '(?is)<a\b[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 1)) AS href,
   unnest(regexp_extract_all({_SHOWN}, '(?is)<a\b[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 2)) AS label,
   unnest(range(len(regexp_extract_all({_SHOWN}, '(?is)<a\b[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 1)))) AS pos FROM pages)"""
_FIRST_LINKS = f"(SELECT * FROM {_LINKS} QUALIFY row_number() OVER (PARTITION BY page_id, href ORDER BY pos) = 1)"


@query("g2_page_links", f"SELECT page_id, {unescape_sql('href')} AS href, {unescape_sql('label')} AS label FROM {_FIRST_LINKS}")
def _(spark, d):
    return spread(table(spark, d, "pages"), width(spark)).select("page_id", F.inline(mk.links("html")))


@query(
    "f32_absolute_url",
    f"""SELECT page_id, CASE WHEN regexp_matches(h, '^[a-z]+:') THEN h WHEN h LIKE '//%' THEN 'https:' || h
          WHEN h LIKE '/%' THEN 'https://shop.example' || h WHEN h LIKE '?%' THEN 'https://shop.example' || h
          ELSE 'https://shop.example/' || h END AS result
        FROM (SELECT page_id, CASE pos % 5 WHEN 0 THEN href WHEN 1 THEN '/' || href WHEN 2 THEN ltrim(href, '/')
          WHEN 3 THEN 'http://other.example' || href ELSE '?q=' || href END AS h
          FROM (SELECT page_id, {unescape_sql('href')} AS href,
            row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS pos FROM {_FIRST_LINKS}))""",
)
def _(spark, d):
    found = spread(table(spark, d, "pages"), width(spark)).select("page_id", F.posexplode(mk.links("html")).alias("pos", "link"))
    href, kind = F.col("link.href"), F.col("pos") % 5
    varied = (
        F.when(kind == 0, href)
        .when(kind == 1, F.concat(F.lit("/"), href))
        .when(kind == 2, F.ltrim(href, F.lit("/")))
        .when(kind == 3, F.concat(F.lit("http://other.example"), href))
        .otherwise(F.concat(F.lit("?q="), href))
    )
    return found.select("page_id", absolute_url("https://shop.example", varied).alias("result"))


LABELS = ["©", "tion", "ier"]


@query(
    "w8_following_line",
    f"""SELECT page_id, lines[list_position(list_transform(lines, lambda x: regexp_matches(lower(x), '©|tion|ier')), true) + 1] AS result
        FROM {_PAGE_LINES}""",
)
def _(spark, d):
    lines = spread(table(spark, d, "pages"), width(spark)).select("page_id", mk.visible_lines("html").alias("lines"))
    return lines.select("page_id", mk.following_line("lines", LABELS).alias("result"))


@query(
    "p16_plausible_prices",
    """SELECT p_partkey, (1 + p_size) || '.' || (200 + p_size) || '.000 đ' AS raw,
       CAST((1 + p_size) * 1000000 + (200 + p_size) * 1000 AS BIGINT) AS vnd FROM part WHERE p_size < 30""",
)
def _(spark, d):
    text = F.array_join(mk.visible_lines("html"), " ")
    return detail_pages(spark, d).select("p_partkey", F.inline(mk.plausible_prices(text, 100_000, 30_500_000)))


@query(
    "g3_listing_rows",
    f"""SELECT CASE p_partkey // {LISTING_SIZE} % 3 WHEN 0 THEN 'links' WHEN 1 THEN 'blocks' ELSE 'cards' END AS source,
        'https://shop.example' || {PRODUCT_PATH} AS url, p_name || ' R&D' AS name,
        coalesce({SHOWN_PRICE}, CASE WHEN p_partkey // {LISTING_SIZE} % 3 = 0 THEN ''
          WHEN p_partkey // {LISTING_SIZE} % 3 = 1 THEN 'Giá Liên hệ' ELSE 'Liên hệ' END) AS price_raw,
        CAST(CASE WHEN p_size % 4 <> 3 THEN (1 + p_size) * 1000000 + (100 + p_size) * 1000 ELSE 0 END AS BIGINT) AS price_vnd
        FROM part""",
)
def _(spark, d):
    return all_listings(listing_pages(spark, d)).select("source", "url", "name", "price_raw", "price_vnd")


def all_listings(pages):
    base, host = "https://shop.example", "shop.example"
    return union_by_name(
        [
            pg.listing_rows_from_links(pages.where("shop = 'links'"), "links", base, host),
            pg.listing_rows_from_cards(pages.where("shop = 'blocks'"), "blocks", base, pg.BLOCK_LAYOUT),
            pg.listing_rows_from_cards(pages.where("shop = 'cards'"), "cards", base, pg.CARD_LAYOUT),
        ]
    )


_BRAND = """coalesce(CASE WHEN p_partkey % 3 <> 0 THEN 'Hãng ' || p_name END,
   CASE WHEN p_partkey % 7 = 0 THEN 'Sony' WHEN p_partkey % 7 = 2 THEN 'JBL' END, '')"""
_CONNECTION = "coalesce(nullif(trim(connection_text), ''), CASE WHEN connection_text IS NOT NULL THEN 'Chi tiết' END, '')"
_HOURS = "CAST(CASE WHEN p_partkey % 4 <> 0 THEN p_size END AS BIGINT)"


@query(
    "g4_page_specs",
    f"""SELECT p_partkey, {_BRAND} AS brand, {_CONNECTION} AS connection, {_HOURS} AS battery_life_hours,
        {GRAMS} AS weight_gram FROM {TEXTS}""",
)
def _(spark, d):
    read = detail_pages(spark, d).select("p_partkey", mk.visible_lines("html").alias("lines"))
    fields = mk.page_specs("lines", fx.PAGE_LABELS, fx.PAGE_BRANDS)
    return read.select("p_partkey", *[c.alias(n) for n, c in fields.items()])


@query(
    "g5_detail_price",
    """SELECT p_partkey, CASE WHEN v BETWEEN 100000 AND 50000000 THEN raw END AS raw,
       CASE WHEN v BETWEEN 100000 AND 50000000 THEN v END AS vnd FROM (SELECT p_partkey,
         (1 + p_size) || '.' || (200 + p_size) || '.000 đ' AS raw,
         CAST((1 + p_size) * 1000000 + (200 + p_size) * 1000 AS BIGINT) AS v FROM part)""",
)
def _(spark, d):
    read = detail_pages(spark, d).select("p_partkey", "html", mk.visible_lines("html").alias("lines"))
    return read.select("p_partkey", pg.detail_price("html", "lines").alias("p")).select("p_partkey", "p.raw", "p.vnd")


_FIRST_BRAND = "CASE WHEN p_partkey % 7 = 0 THEN 'Sony' WHEN p_partkey % 7 = 2 THEN 'JBL' ELSE '' END"
_NO_PRICE = "(p_size % 4 = 3)"


def _merged_sql():
    """Rule of the first shop: only unpriced rows change, and then in every field."""
    return f"""SELECT 'https://shop.example' || {PRODUCT_PATH} AS url, p_name || ' R&D' AS name,
        CASE WHEN {_NO_PRICE} THEN (1 + p_size) * 1000000 + (200 + p_size) * 1000
             ELSE (1 + p_size) * 1000000 + (100 + p_size) * 1000 END::BIGINT AS price_vnd,
        CASE WHEN {_NO_PRICE} THEN {_FIRST_BRAND} END AS brand,
        CASE WHEN {_NO_PRICE} THEN {_CONNECTION} END AS connection,
        CASE WHEN {_NO_PRICE} THEN {GRAMS} END AS weight_gram,
        CASE WHEN {_NO_PRICE} THEN '' END AS type
        FROM {TEXTS} WHERE p_partkey // {LISTING_SIZE} % 3 = 0"""


@query("g6_merge_details_first_shop", _merged_sql())
def _(spark, d):
    rows = all_listings(listing_pages(spark, d)).where("source = 'links'").select(
        "url", "name", "price_raw", "price_vnd"
    )
    details = pg.detail_specs(detail_pages(spark, d), first_shop=True)
    return pg.merge_details(rows, details, overwrite_empty=True).select(
        "url", "name", "price_vnd", "brand", "connection", "weight_gram", "type"
    )


@query(
    "g6_merge_details_other_shops",
    f"""SELECT 'https://shop.example' || {PRODUCT_PATH} AS url, coalesce(nullif({_BRAND}, ''),
          regexp_extract(p_name, '[a-z]{{3,}}')) AS brand, {_CONNECTION} AS connection,
        {_HOURS} AS battery_life_hours, {GRAMS} AS weight_gram
        FROM {TEXTS} WHERE p_partkey // {LISTING_SIZE} % 3 > 0""",
)
def _(spark, d):
    rows = all_listings(listing_pages(spark, d)).where("source <> 'links'").withColumn("connection", F.lit(""))
    merged = pg.merge_details(rows, pg.detail_specs(detail_pages(spark, d)), overwrite_empty=False)
    return merged.select("url", "brand", "connection", "battery_life_hours", "weight_gram")


def _spec_rows_sql(categories):
    return f"""SELECT p_partkey, category, key, value FROM (SELECT p_partkey, unnest([
          {{'category': '{categories[0]}', 'key': 'Mẫu', 'value': p_name}},
          {{'category': '{categories[1]}', 'key': 'Thương hiệu', 'value': CASE WHEN p_partkey % 3 <> 0 THEN 'Hãng ' || p_name END}},
          {{'category': '{categories[1]}', 'key': 'Cổng kết nối', 'value': {strip('connection_text')}}},
          {{'category': '{categories[2]}', 'key': 'Thời lượng pin', 'value': CASE WHEN p_partkey % 4 <> 0
             THEN p_size || ' giờ (ANC), | ' || (p_size + 7) || ' giờ' END}},
          {{'category': '{categories[2]}', 'key': 'Trọng lượng', 'value': weight_text}}], recursive := true) FROM {TEXTS})
        WHERE value IS NOT NULL"""


@query("m5_table_specs", _spec_rows_sql(["Thông tin chung", "Chung", "Chi tiết"]))
def _(spark, d):
    specs = detail_pages(spark, d).select("p_partkey", F.explode(mk.table_specs("html")).alias("s"))
    return specs.select("p_partkey", F.col("s.category").alias("category"), F.explode("s.details"))


@query(
    "m6_sectioned_specs",
    f"""SELECT doc_id, category, key, value FROM (SELECT doc_id, unnest([
          {{'category': 'Màn hình', 'key': 'lang', 'value': lang}}, {{'category': 'Màn hình', 'key': 'source', 'value': source}},
          {{'category': 'Nội dung', 'key': 'text', 'value': CASE WHEN contains({strip('text')}, chr(10)) THEN array_to_string(list_filter(list_transform(
             string_split(text, chr(10)), lambda x: {strip('x')}), lambda x: x <> ''), ' | ') ELSE {strip('text')} END}}], recursive := true)
        FROM documents)""",
)
def _(spark, d):
    def row(label, value):
        escaped = F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        lined = F.regexp_replace(escaped, "\n", "<br>")
        return F.concat(F.lit(f'<tr class="technical-content-item"><td>{label}</td><td>'), lined, F.lit("</td></tr>"))

    def section(title, *rows):
        return F.concat(
            F.lit(f'<div class="technical-content-section"><p class="title">{title}</p><table>'), *rows, F.lit("</table></div>")
        )

    html = F.concat(
        F.lit("<html><body>"),
        section("Màn hình", row("lang", F.col("lang")), row("source", F.col("source"))),
        section("Nội dung", row("text", F.col("text"))),
        section("Trống"),
    )
    pages = spread(table(spark, d, "documents"), width(spark)).select("doc_id", html.alias("html"))
    specs = pages.select("doc_id", F.explode(mk.sectioned_specs("html")).alias("s"))
    return specs.select("doc_id", F.col("s.category").alias("category"), F.explode("s.details"))


