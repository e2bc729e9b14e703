"""Text functions (F)."""

from pyspark.sql import functions as F

from shelfwise import fixed_values as fx
from shelfwise.functions import headphone as hp
from shelfwise.functions import numeric as nm
from shelfwise.functions import phone as ph
from shelfwise.functions import text as tx
from shelfwise.functions import urls
from shelfwise.functions.specs import merged_specs
from shelfwise.queries import query
from shelfwise.queries.sql import strip
from shelfwise.sources.derived import PHONE_NAME, nested_catalog, spec_texts, spec_texts_sql
from shelfwise.sources.tables import spread, table, width

TEXTS = spec_texts_sql()


def sql_extract(column, pattern, group=1, flags="i"):
    return f"nullif(regexp_extract({column}, '{pattern}', {group}, '{flags}'), '')"


def squeeze_sql(x):
    return strip(rf"regexp_replace({x}, '\s+', ' ', 'g')")


def over_texts(name, sql, build, *more):
    """Register one expression over the derived specification texts."""
    columns = ", ".join([f"{sql} AS result", *more])

    @query(name, f"SELECT p_partkey, {columns} FROM {TEXTS}")
    def _(spark, d):
        built = build()
        built = built if isinstance(built, dict) else {"result": built}
        return spec_texts(spark, d).select("p_partkey", *[c.alias(n) for n, c in built.items()])


def over_documents(name, sql, build):
    @query(name, f"SELECT doc_id, {sql} AS result FROM documents")
    def _(spark, d):
        return spread(table(spark, d, "documents"), width(spark)).select("doc_id", build().alias("result"))


FIRST = [r"version\s+([\d.]+)", r"(\d+)\s*(?:hz|mp|gb)", r"(\d[\d.,-]*)", r"(?:^|\s)(l\w+)\s"]
over_documents(
    "f1_first_match",
    "coalesce("
    + ", ".join(strip(sql_extract("text", p.replace(r"\w", r"[\p{L}\p{N}_]"))) for p in FIRST)
    + ")",
    lambda: tx.first_match("text", FIRST),
)

over_texts(
    "f2_price_digits",
    "TRY_CAST(regexp_replace(" + sql_extract("price_text", r"([\d.,]+)") + ", '[.,]', '', 'g') AS BIGINT)",
    lambda: tx.price_digits("price_text"),
)

over_texts(
    "f3_price_or_zero",
    "coalesce(TRY_CAST("
    + sql_extract("regexp_replace(price_text, '[.,₫đ ]', '', 'g')", r"(\d+)")
    + " AS BIGINT), 0)",
    lambda: tx.price_or_zero("price_text"),
)


@query(
    "f4_price_fragment",
    "SELECT page_id, " + strip(sql_extract("html", r"[\d.,]+\s*[đ₫]?", 0)) + " AS result FROM pages",
)
def _(spark, d):
    return spread(table(spark, d, "pages"), width(spark)).select("page_id", tx.price_fragment("html").alias("result"))


over_texts(
    "f5_cpu", "split_part(nullif(chipset_text, ''), ' | ', 1)", lambda: ph.cpu("chipset_text")
)

_GB = sql_extract("{0}", r"(\d+(\.\d+)?)\s*(gb|g\b)")
_NUM = sql_extract("{0}", r"(\d+(\.\d+)?)")


def gb_sql(c):
    return f"CAST(coalesce({_GB.replace('{0}', c)}, {_NUM.replace('{0}', c)}) AS DOUBLE)"


def rom_sql(c):
    tb = sql_extract(c, r"(\d+(\.\d+)?)\s*(tb|t\b)")
    return f"coalesce(CAST({tb} AS DOUBLE) * 1024, {gb_sql(c)})"


def inches_sql(c):
    return f"coalesce({sql_extract(c, r'([\d.|,]+)\s*inches?', 1, 'c')}, {sql_extract(c, r'([\d.]+)')})"


def resolution_sql(c):
    sides = r"(\d+)\s*[xX×]\s*(\d+)"
    return f"""CASE WHEN regexp_matches({c}, '{sides}')
        THEN regexp_extract({c}, '{sides}', 1) || ' x ' || regexp_extract({c}, '{sides}', 2)
        ELSE coalesce({sql_extract(c, r'([\d.]+\s*K)')},
        {sql_extract(c, r'(Full HD|FHD|HD\+|HD|UHD|2K|QHD|WQHD)')}, nullif({c}, '')) END"""


def tech_sql(c):
    main = r"màn\s+chính\s*:\s*([^,.;]*)"
    return f"""CASE WHEN regexp_matches({c}, '{main}', 'i')
        THEN {strip(f"regexp_extract({c}, '{main}', 1, 'i')")} ELSE nullif({c}, '') END"""


def hz_sql(own, second):
    def hz(c):
        return f"CAST({sql_extract(c, r'(\d+)\s*hz')} AS INTEGER)"

    return f"""CASE WHEN coalesce({own}, '') <> '' THEN coalesce({hz(own)}, TRY_CAST({own} AS INTEGER))
        ELSE {hz(second)} END"""


def mp_sql(c):
    return rf"list_transform(regexp_extract_all(nullif({c}, ''), '(\d+(\.\d+)?)\s*mp', 1, 'i'), lambda x: CAST(x AS DOUBLE))"


def battery_sql(c):
    return f"""CAST(nullif(regexp_replace({sql_extract(squeeze_sql(c), r'([\d.,]+)\s*mAh')},
        '[^0-9]', '', 'g'), '') AS INTEGER)"""


def security_sql(parts):
    finger = " OR ".join(f"coalesce(regexp_matches(lower({c}), 'vân tay|fingerprint'), false)" for c in parts)
    face = " OR ".join(
        f"coalesce(regexp_matches(lower({c}), 'face id|face unlock|nhận diện khuôn mặt'), false)" for c in parts
    )
    return f"""coalesce(nullif(concat_ws(', ', CASE WHEN {face} THEN 'Face ID' END,
        CASE WHEN {finger} THEN 'Vân tay' END), ''), 'Mật khẩu')"""


over_texts("f6_ram_gb", gb_sql("ram_text"), lambda: ph.ram_gb("ram_text"))
over_texts("f7_storage_gb", rom_sql("rom_text"), lambda: ph.storage_gb("rom_text"))
over_texts("f8_screen_inches", inches_sql("size_text"), lambda: ph.screen_inches("size_text"))
over_texts("f9_resolution_text", resolution_sql("resolution_text"), lambda: ph.resolution_text("resolution_text"))
over_texts("f10_screen_tech", tech_sql("tech_text"), lambda: ph.screen_tech("tech_text"))
over_texts("f11_refresh_hz", hz_sql("hz_text", "standard_text"), lambda: ph.refresh_hz("hz_text", "standard_text"))
over_texts(
    "f12_camera",
    f"CAST(list_max({mp_sql('camera_text')}) AS VARCHAR) || ' MP'",
    lambda: {"result": ph.camera_resolution("camera_text"), "cameras": ph.camera_count("camera_text")},
    f"CAST(len({mp_sql('camera_text')}) AS INTEGER) AS cameras",
)
over_texts("f13_battery_mah", battery_sql("battery_text"), lambda: ph.battery_mah("battery_text"))

_LOW = "lower(text)"
over_documents(
    "f14_wireless_tags",
    f"""nullif(array_to_string(list_sort(list_distinct(list_filter([
        CASE WHEN contains({_LOW}, '5g') OR contains(lower(source), '5g') THEN '5G' END,
        CASE WHEN contains({_LOW}, '4g') OR contains({_LOW}, 'lte') OR contains(lower(source), '4g') THEN '4G' END,
        CASE WHEN contains({_LOW}, '3g') THEN '3G' END,
        CASE WHEN regexp_matches({_LOW}, 'wi-?fi') THEN concat_ws(' ', 'WiFi', coalesce(
            {sql_extract(_LOW, r'wifi\s*([\d.]+)')}, {sql_extract(_LOW, r'wi-fi\s*([\d.]+)')})) END,
        CASE WHEN contains({_LOW}, 'bluetooth') THEN concat_ws(' ', 'Bluetooth', {sql_extract(_LOW, r'bluetooth\s*([\d.]+)')}) END,
        CASE WHEN contains({_LOW}, 'nfc') THEN 'NFC' END,
        CASE WHEN contains({_LOW}, 'gps') THEN 'GPS' END], lambda x: x IS NOT NULL))), ', '), '')""",
    lambda: ph.wireless_tags(F.create_map(F.lit("text"), F.col("text")), "source"),
)
over_documents(
    "f15_security_tags",
    security_sql(["text"]),
    lambda: ph.security_tags(F.create_map(F.lit("text"), F.col("text"))),
)

CATALOG_FEATURES_SQL = f"""SELECT 'https://shop.example/p' || p_partkey || '.html' AS url,
  CASE WHEN ok THEN {PHONE_NAME} END AS name,
  CASE WHEN ok THEN TRY_CAST(regexp_replace({sql_extract('price_text', r'([\d.,]+)')}, '[.,]', '', 'g') AS BIGINT) END AS price,
  CASE WHEN ok THEN nullif(chipset_text, '') END AS chipset,
  CASE WHEN ok THEN split_part(nullif(chipset_text, ''), ' | ', 1) END AS cpu,
  CASE WHEN ok THEN {gb_sql('coalesce(ram_text, size_text)')} END AS ram,
  CASE WHEN ok THEN {rom_sql('rom_text')} END AS internal_memory,
  CASE WHEN ok THEN {inches_sql('size_text')} END AS screen_size,
  CASE WHEN ok THEN {resolution_sql('resolution_text')} END AS screen_resolution,
  CASE WHEN ok THEN {tech_sql('tech_text')} END AS screen_tech,
  CASE WHEN ok THEN {hz_sql('hz_text', 'standard_text')} END AS refresh_rate,
  CASE WHEN ok THEN CAST(list_max({mp_sql('camera_text')}) AS VARCHAR) || ' MP' END AS camera_main_resolution,
  CASE WHEN ok THEN CAST(len({mp_sql('camera_text')}) AS INTEGER) END AS camera_count,
  CASE WHEN ok THEN {battery_sql('battery_text')} END AS battery_capacity,
  CASE WHEN ok THEN {security_sql(['security_text'])} ELSE 'Mật khẩu' END AS security
  FROM (SELECT *, p_partkey % 17 <> 0 AS ok FROM {TEXTS})"""


@query("f16_all_features", CATALOG_FEATURES_SQL)
def _(spark, d):
    catalog = nested_catalog(spark, d).withColumn("specs", merged_specs("specifications"))
    return catalog.select(*ph.features("specs"))


over_documents(
    "f17_clean_name",
    squeeze_sql(r"regexp_replace(regexp_replace(text, '\([^)]*\)', '', 'g'), '\[[^\]]*\]', '', 'g')"),
    lambda: tx.clean_name("text"),
)
over_documents(
    "f18_clean_chipset",
    squeeze_sql(
        r"regexp_replace(regexp_replace(text, '\([^)]*\)', '', 'g'), '[^\p{L}\p{M}\p{N}_\s]', '', 'g')"
    ),
    lambda: tx.clean_chipset("text"),
)
over_texts(
    "f19_camera_mp",
    r"list_max(list_transform(regexp_extract_all(camera_text, '\d+'), lambda x: CAST(x AS INTEGER)))",
    lambda: ph.camera_mp("camera_text"),
)

_KEYS = " ".join(f"WHEN '{n}' THEN '{w} x {h}'" for n, (w, h) in fx.K_RESOLUTIONS.items())
_KV = sql_extract("lower(resolution_text)", r"(\d+(\.\d+)?)\s*k")
_INTS = r"list_sort(list_transform(regexp_extract_all(resolution_text, '\d+'), lambda x: CAST(x AS BIGINT)))"
NORMAL_RESOLUTION = f"""CASE WHEN {_KV} IS NOT NULL THEN CASE (CASE WHEN contains({_KV}, '.')
      THEN CAST(CAST({_KV} AS DOUBLE) AS VARCHAR) ELSE CAST(CAST({_KV} AS BIGINT) AS VARCHAR) END || 'K') {_KEYS} END
    WHEN len({_INTS}) = 2 THEN {_INTS}[1] || ' x ' || {_INTS}[2] END"""
over_texts("f20_normal_resolution", NORMAL_RESOLUTION, lambda: ph.normal_resolution("resolution_text"))


def chip_sql(c):
    low = f"lower({c})"
    steps = []
    for pattern, template in fx.CHIP_RULES:
        model = f"nullif({strip(sql_extract(low, pattern))}, '')"
        before, after = template.split("{0}")
        steps.append(
            f"('{before}' || CASE WHEN starts_with({model}, 'g') THEN upper({model}) ELSE {model} END || '{after}')"
        )
    general = fx.CHIP_GENERAL.replace(r"\w", r"[\p{L}\p{N}_]")
    word = sql_extract(low, general)
    steps.append(f"(upper({word}[1]) || {word}[2:] || ' ' || {sql_extract(low, general, 2)})")
    steps.append(f"CASE WHEN {c} <> '' THEN {squeeze_sql(c)} END")
    return "coalesce(" + ", ".join(steps) + ", 'Unknown')"


over_texts("f21_chip_model", chip_sql("chipset_text"), lambda: ph.chip_model("chipset_text"))


@query("f22_operating_system", "SELECT p_partkey, CASE p_brand WHEN 'Apple' THEN 'iOS' ELSE 'Android' END AS result "
       "FROM (SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'Apple' ELSE p_brand END AS p_brand FROM part)")
def _(spark, d):
    brand = F.when(F.col("p_partkey") % 4 == 0, "Apple").otherwise(F.col("p_brand"))
    return table(spark, d, "part").select("p_partkey", ph.operating_system(brand).alias("result"))


over_documents("f23_before_colon", "split_part(text, ':', 1)", lambda: tx.before_colon("text"))

over_texts(
    "f24_connector",
    f"""CASE WHEN s = '' OR length(s) > 20 THEN NULL WHEN contains(lower(s), '3.5') THEN '3.5mm'
        WHEN regexp_matches(lower(s), 'type c|usb.c') THEN 'Type C' WHEN starts_with(lower(s), 'usb') THEN 'USB-A'
        WHEN regexp_matches(lower(s), 'bluetooth|wireless') THEN 'Bluetooth'
        WHEN s IN ('3.5mm', 'Type C', 'USB-A', 'USB-C', 'Bluetooth', 'Wireless') THEN s END""".replace(
        "(s)", "(trim(connection_text))"
    )
    .replace(" s ", " trim(connection_text) ")
    .replace("(s,", "(trim(connection_text),"),
    lambda: hp.connector("connection_text"),
)


def traits_sql(n, gaming, in_ear):
    low = f"lower(coalesce({n}, ''))"
    return [
        f"""CASE WHEN regexp_matches({low}, 'chụp tai|chup tai|over-ear') THEN 'over-ear'
        WHEN regexp_matches({low}, '{in_ear}') THEN 'in-ear' ELSE '' END AS type""",
        f"CAST(regexp_matches({low}, '{gaming}') AS INTEGER) AS is_gaming",
        f"CAST(regexp_matches({low}, 'bluetooth|wireless') AS INTEGER) AS is_wireless",
        f"CAST(contains({low}, 'mic') AS INTEGER) AS has_mic",
    ]


@query(
    "f25_name_traits",
    "SELECT p_partkey, " + ", ".join(traits_sql("headphone_name", "gaming|game", "nhét tai|nhet tai|earbuds")) + f" FROM {TEXTS}",
)
def _(spark, d):
    traits = hp.name_traits("headphone_name", "first")
    return spec_texts(spark, d).select("p_partkey", *[c.alias(n) for n, c in traits.items()])


BRAND_GUESS = (
    r"coalesce(regexp_extract(headphone_name, '(?:^|[^\p{L}\p{N}_])([a-zA-Z]{3,})(?:[^\p{L}\p{N}_]|$)', 1), '') AS brand"
)


@query(
    "f26_name_traits_with_brand",
    "SELECT p_partkey, "
    + ", ".join([*traits_sql("headphone_name", "gaming", "in-ear|nhét tai|nhet tai"), BRAND_GUESS])
    + f" FROM {TEXTS}",
)
def _(spark, d):
    traits = hp.name_traits("headphone_name", "other")
    return spec_texts(spark, d).select(
        "p_partkey", *[c.alias(n) for n, c in traits.items()], hp.brand_guess("headphone_name").alias("brand")
    )


over_texts(
    "f27_word_flag",
    "CAST(coalesce(regexp_matches(lower(headphone_name), 'true wireless|bluetooth'), false) AS INTEGER)",
    lambda: tx.flag("headphone_name", "true wireless|bluetooth"),
)
over_documents("f28_shorten", "substring(text, 1, 300)", lambda: tx.shorten("text"))
over_documents(
    "f29_label_key",
    f"lower(rtrim({strip(chr(39) + '  ' + chr(39) + ' || source || ' + chr(39) + '::' + chr(39))}, ':'))",
    lambda: tx.label_key(F.concat(F.lit("  "), F.col("source"), F.lit("::"))),
)


@query(
    "f30_two_way_split",
    f"""SELECT p_partkey, TRY_CAST(split_part(r, ' x ', 1) AS DOUBLE) AS screen_width,
        TRY_CAST(split_part(r, ' x ', 2) AS DOUBLE) AS screen_height
        FROM (SELECT p_partkey, {NORMAL_RESOLUTION} AS r FROM {TEXTS})""",
)
def _(spark, d):
    texts = spec_texts(spark, d).select("p_partkey", ph.normal_resolution("resolution_text").alias("r"))
    width, height = ph.sides("r")
    return texts.select("p_partkey", width.alias("screen_width"), height.alias("screen_height"))


def over_pages(name, sql, build):
    @query(name, f"SELECT page_id, {sql} AS result FROM pages")
    def _(spark, d):
        return spread(table(spark, d, "pages"), width(spark)).select("page_id", build().alias("result"))


over_pages("f31_slug", "replace(split_part(url, '/', -1), '.html', '')", lambda: urls.slug("url"))
over_pages(
    "f33_page_url",
    r"""CASE WHEN regexp_matches(url, '[?&]page=') THEN regexp_replace(url, '([?&])page=[^&#]*', '\1page=3')
        ELSE regexp_replace(url, '^([^#]*)(.*)$', CASE WHEN contains(url, '?') THEN '\1&page=3\2' ELSE '\1?page=3\2' END)
        END""",
    lambda: urls.page_url("url", 3),
)


@query(
    "f33_search_url",
    "SELECT doc_id, 'https://shop.example/search?q=' || replace(url_encode(lang || ' ' || source || ' tai nghe'), '+', '%20') AS result FROM documents",
)
def _(spark, d):
    words = F.concat_ws(" ", "lang", "source", F.lit("tai nghe"))
    return spread(table(spark, d, "documents"), width(spark)).select(
        "doc_id", urls.search_url("https://shop.example", "/search", words).alias("result")
    )


@query(
    "f34_clock_text",
    """SELECT event_id, printf('%02d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) AS result
       FROM (SELECT event_id, greatest(CAST(trunc((value - 5) * 60) AS BIGINT), 0) AS s FROM events)""",
)
def _(spark, d):
    return table(spark, d, "events").select("event_id", nm.clock_text((F.col("value") - 5) * 60).alias("result"))
