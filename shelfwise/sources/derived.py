"""Catalog-like inputs that Spark derives from the given tables.

The text expressions are plain SQL that both Spark and the checking engine understand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.sources.tables import spread, table, width

_S = "CAST(p_size AS STRING)"
_K = "CAST(p_partkey AS STRING)"

SPEC_TEXTS = {
    "price_text": "CASE p_partkey % 6 WHEN 0 THEN 'Liên hệ' WHEN 1 THEN '' WHEN 2 THEN NULL "
    f"WHEN 3 THEN 'Giá: ' || {_S} || '.' || CAST(100 + p_size AS STRING) || '.000₫ cũ 9.000đ' "
    f"WHEN 4 THEN {_S} || ',' || CAST(200 + p_size AS STRING) || ' 000 đ' ELSE {_S} || '900000' END",
    "chipset_text": "CASE p_partkey % 9 WHEN 0 THEN 'Snapdragon 8 Elite' WHEN 1 THEN 'Helio A' || " + _S
    + " WHEN 2 THEN 'SM' || CAST(8000 + p_size AS STRING) WHEN 3 THEN '' "
    "WHEN 4 THEN 'Dimensity ' || CAST(7000 + p_size AS STRING) || ' Pro | 8 nhân' "
    "WHEN 5 THEN 'Google Tensor G' || " + _S + " WHEN 6 THEN 'Exynos 1380 (5nm)' "
    "WHEN 7 THEN NULL ELSE 'chip   lạ' END",
    "ram_text": f"CASE p_size % 6 WHEN 0 THEN {_S} || ' GB' WHEN 1 THEN {_S} "
    f"WHEN 2 THEN 'RAM ' || {_S} || '.5g mở rộng 4 GB' WHEN 3 THEN '' WHEN 4 THEN 'không rõ' ELSE NULL END",
    "rom_text": f"CASE p_size % 6 WHEN 0 THEN {_S} || ' TB' WHEN 1 THEN {_S} || 'GB' WHEN 2 THEN {_S} "
    f"WHEN 3 THEN '1.5 tb hoặc 512 GB' WHEN 4 THEN 'tối đa' ELSE NULL END",
    "size_text": f"CASE p_size % 6 WHEN 0 THEN '6.' || {_S} || ' inches' WHEN 1 THEN '6.' || {_S} || ' inch' "
    f"WHEN 2 THEN '6,' || {_S} || ' inches' WHEN 3 THEN 'màn ' || {_S} WHEN 4 THEN 'lớn' ELSE NULL END",
    "resolution_text": f"CASE p_size % 8 WHEN 0 THEN '1080 x ' || CAST(2300 + p_size AS STRING) || ' px' "
    f"WHEN 1 THEN {_S} || '.5K' WHEN 2 THEN 'Full HD+' WHEN 3 THEN '2k' WHEN 4 THEN 'siêu nét' "
    f"WHEN 5 THEN CAST(3000 + p_size AS STRING) || '×1440' WHEN 6 THEN '' ELSE NULL END",
    "tech_text": "CASE p_size % 5 WHEN 0 THEN 'MÀN chính: AMOLED ' || " + _S + " || ', phụ: LCD' "
    "WHEN 1 THEN 'IPS LCD' WHEN 2 THEN 'Màn  chính :OLED' WHEN 3 THEN '' ELSE NULL END",
    "hz_text": f"CASE p_size % 5 WHEN 0 THEN {_S} || ' Hz' WHEN 1 THEN {_S} || 'hz động' "
    f"WHEN 2 THEN {_S} WHEN 3 THEN '' ELSE NULL END",
    "standard_text": f"CASE p_size % 3 WHEN 0 THEN 'FHD+, ' || {_S} || ' HZ' WHEN 1 THEN 'FHD+' ELSE NULL END",
    "camera_text": f"CASE p_size % 5 WHEN 0 THEN {_S} || ' MP + 12.2 mp' WHEN 1 THEN {_S} || '.5MP' "
    "WHEN 2 THEN 'dual' WHEN 3 THEN '' ELSE NULL END",
    "battery_text": f"CASE p_size % 5 WHEN 0 THEN '5.0' || {_S} || ' mAh' WHEN 1 THEN '4,5' || {_S} || '  mah Li-Po' "
    f"WHEN 2 THEN {_S} || ' giờ' WHEN 3 THEN '' ELSE NULL END",
    "security_text": "CASE p_size % 4 WHEN 0 THEN 'Vân tay cạnh bên' WHEN 1 THEN 'FACE ID, VÂN TAY' "
    "WHEN 2 THEN 'PIN' ELSE NULL END",
    "connection_text": "CASE p_size % 9 WHEN 0 THEN 'Jack 3.5 mm' WHEN 1 THEN ' USB Type C ' WHEN 2 THEN 'USB 2.0' "
    "WHEN 3 THEN 'Wireless' WHEN 4 THEN 'cáp nối dài hơn hai mươi ký tự' WHEN 5 THEN 'HDMI' WHEN 6 THEN '  ' "
    "WHEN 7 THEN 'usb-c' ELSE NULL END",
    "weight_text": f"CASE p_size % 5 WHEN 0 THEN {_S} || ' g' WHEN 1 THEN '0.' || {_S} || ' kg' "
    f"WHEN 2 THEN 'khoảng ' || {_S} || ',5G' WHEN 3 THEN 'nhẹ' ELSE NULL END",
    "headphone_name": "CASE p_partkey % 7 WHEN 0 THEN 'Tai nghe chụp tai Sony ' || p_name "
    "WHEN 1 THEN 'Tai nghe Bluetooth nhét tai ' || p_name WHEN 2 THEN 'Chụp gaming JBL ' || p_name || ' Micro' "
    "WHEN 3 THEN 'Game OVER-EAR ' || p_name || ' wireless' WHEN 4 THEN 'In-Ear ' || p_name "
    f"WHEN 5 THEN 'Earbuds ' || p_name ELSE NULL END",
}

PHONE_NAME = (
    "CASE p_partkey % 6 WHEN 0 THEN 'Redmi ' || p_name WHEN 1 THEN 'Điện thoại SAMSUNG ' || p_name || ' (2024) [mới]' "
    "WHEN 2 THEN 'Apple ' || p_name WHEN 3 THEN p_name || ' moto blu' WHEN 4 THEN 'Pin dự phòng watch ' || p_name "
    "ELSE p_name END"
)


def spec_texts(spark: SparkSession, folder: str) -> DataFrame:
    """``part`` with one specification text per kind."""
    return spread(table(spark, folder, "part"), width(spark)).select(
        "p_partkey", "p_name", "p_size", *[F.expr(e).alias(n) for n, e in SPEC_TEXTS.items()]
    )


def spec_texts_sql() -> str:
    cells = ", ".join(f"{e} AS {n}" for n, e in SPEC_TEXTS.items())
    return f"(SELECT p_partkey, p_name, p_size, {cells} FROM part)"


def nested_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Crawl-like nested products: some labels capitalised or repeated, some records failed."""
    texts = spec_texts(spark, folder)

    def details(*pairs):
        cells = F.array(
            *[F.struct(F.lit(k).alias("key"), F.col(v).alias("value")) for k, v in pairs]
        )
        return F.map_from_entries(F.filter(cells, lambda c: c["value"].isNotNull()))

    def section(title, *pairs):
        return F.struct(F.lit(title).alias("category"), details(*pairs).alias("details"))

    specs = F.array(
        section("Vi xử lý", ("Chipset", "chipset_text"), ("RAM", "size_text")),
        section("Bộ nhớ", ("ram", "ram_text"), ("Bộ nhớ trong", "rom_text")),
        section(
            "Màn hình",
            ("Kích thước màn hình", "size_text"),
            ("Độ phân giải", "resolution_text"),
            ("Công nghệ màn hình", "tech_text"),
            ("Tần số quét", "hz_text"),
            ("Chuẩn màn hình", "standard_text"),
        ),
        section("Khác", ("Camera sau", "camera_text"), ("Pin", "battery_text"), ("Bảo mật", "security_text")),
    )
    failed = F.col("p_partkey") % 17 == 0
    return texts.select(
        F.concat(F.lit("https://shop.example/p"), F.col("p_partkey").cast("string"), F.lit(".html")).alias("url"),
        F.when(~failed, F.expr(PHONE_NAME)).alias("name"),
        F.when(~failed, F.col("price_text")).alias("price"),
        F.when(failed, F.lit("timeout")).alias("error"),
        F.when(~failed, specs).alias("specifications"),
    )


LISTING_SIZE = 40
SHOPS = ["links", "blocks", "cards"]

#: Price as shown: grouped, missing in the first shop or 'Liên hệ' elsewhere for a quarter.
SHOWN_PRICE = (
    "CASE WHEN p_size % 4 <> 3 THEN CAST(1 + p_size AS STRING) || '.' || CAST(100 + p_size AS STRING) || '.000₫' END"
)
PRODUCT_PATH = "'/tai-nghe-chup-tai-' || CAST(p_partkey AS STRING) || '.html'"


def listing_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Listing pages of three shops with up to 40 products each: (page_no, shop, html)."""
    shop = (F.col("page_no") % 3).cast("int")
    price = F.expr(SHOWN_PRICE)
    path = F.expr(PRODUCT_PATH)
    name = F.concat("p_name", F.lit(" R&amp;D"))
    links = F.concat(
        F.lit('<div class="item"><a href="'), path, F.lit('"><img src="i.png"></a><h3><a href="'), path,
        F.lit('">'), name, F.lit("</a></h3>"),
        F.coalesce(F.concat(F.lit('<p class="item-Price">'), price, F.lit("</p>")), F.lit("")),
        F.lit('</div><a href="/gioi-thieu.html">x</a>'),
    )
    shown = F.coalesce(price, F.lit("Liên hệ"))
    blocks = F.concat(
        F.lit('<div class="proloop-block"><div class="proloop-img"><a href="'), path,
        F.lit('"><img src="i.png"></a></div><h3 class="proloop-name"><a href="'), path, F.lit('">'), name,
        F.lit('</a></h3><span class="proloop-price--highlight">Giá '), shown, F.lit("</span></div>"),
    )
    cards = F.concat(
        F.lit("<div class='product-card x'><a href='"), path, F.lit("'><h3 class='css-1xdyrhj'>"), name,
        F.lit("</h3><div class='att-product-detail-latest-price'>"), shown, F.lit("</div></a></div>"),
    )
    parts = table(spark, folder, "part").withColumn("page_no", F.floor(F.col("p_partkey") / LISTING_SIZE))
    card = F.when(shop == 0, links).when(shop == 1, blocks).otherwise(cards)
    return (
        parts.select("page_no", "p_partkey", card.alias("card"))
        .groupBy("page_no")
        .agg(F.sort_array(F.collect_list(F.struct("p_partkey", "card"))).alias("c"))
        .select(
            "page_no",
            F.element_at(F.array(*[F.lit(s) for s in SHOPS]), shop + 1).alias("shop"),
            F.concat(
                F.lit("<html><body><script>var a='<a href=\"/tai-nghe-chup-tai-0.html\">';</script>"),
                F.array_join(F.transform("c", lambda x: x["card"]), "\n"),
                F.lit("</body></html>"),
            ).alias("html"),
        )
    )


def detail_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One detail page per part: (p_partkey, url, html) with a price line and a spec table."""
    key = F.col("p_partkey")
    texts = spec_texts(spark, folder)

    def row(label, value):
        return F.coalesce(
            F.concat(F.lit(f"<tr><td>{label}:</td><td>"), value, F.lit("</td></tr>")), F.lit("")
        )

    hours = F.concat(
        F.col("p_size").cast("string"), F.lit(" giờ (ANC),<br>"), (F.col("p_size") + 7).cast("string"), F.lit(" giờ")
    )
    html = F.concat(
        F.lit("<html><body><h1>"), F.coalesce("headphone_name", "p_name"), F.lit("</h1><p>Mã 12.345 giá "),
        F.expr("CAST(1 + p_size AS STRING) || '.' || CAST(200 + p_size AS STRING) || '.000 đ'"),
        F.lit("</p><table><tr><td>Mẫu</td><td>"), F.col("p_name"), F.lit("</td></tr><tr><td colspan=2>Chung</td></tr>"),
        row("Thương hiệu", F.when(key % 3 != 0, F.concat(F.lit("Hãng "), F.col("p_name")))),
        row("Cổng kết nối", F.col("connection_text")),
        F.lit("<tr><td colspan=2>Chi tiết</td></tr>"),
        row("Thời lượng pin", F.when(key % 4 != 0, hours)),
        row("Trọng lượng", F.col("weight_text")),
        F.lit("</table></body></html>"),
    )
    url = F.concat(F.lit("https://shop.example"), F.expr(PRODUCT_PATH))
    return texts.select("p_partkey", url.alias("url"), html.alias("html"))
