"""End-to-end jobs (X)."""

from pyspark.sql import functions as F

from shelfwise import fixed_values as fx
from shelfwise.operators import pages as pg
from shelfwise.operators import rows
from shelfwise.plans import calls, catalog, headphones, report, shops
from shelfwise.queries import query
from shelfwise.queries.aggregates import rounded
from shelfwise.queries.encoding import grouped_sql, melted, one_hot_sql
from shelfwise.queries.markup import _BRAND, _CONNECTION, _FIRST_BRAND, _HOURS, _NO_PRICE
from shelfwise.queries.numbers import GRAMS
from shelfwise.queries.scans import product_lines
from shelfwise.queries.sql import PART_GAPS, union_all
from shelfwise.queries.texts import (
    CATALOG_FEATURES_SQL,
    NORMAL_RESOLUTION,
    chip_sql,
    squeeze_sql,
)
from shelfwise.session import hand_off, scratch_path
from shelfwise.sources import readers, writers
from shelfwise.sources.derived import (
    LISTING_SIZE,
    PRODUCT_PATH,
    detail_pages,
    listing_pages,
    nested_catalog,
    spec_texts,
    spec_texts_sql,
)
from shelfwise.sources.tables import part_with_gaps, table

TEXTS = spec_texts_sql()


@query("x1_extract_catalog", CATALOG_FEATURES_SQL)
def _(spark, d):
    """Nested JSON lines in, one feature row per product out."""
    products = readers.read_products(spark, product_lines(spark, d))
    return hand_off(catalog.extract_features(products), "features")


def _catalog_features(spark, d):
    key = F.regexp_extract("url", r"p(\d+)\.html", 1).cast("long").alias("ordinal")
    return catalog.extract_features(nested_catalog(spark, d).select("*", key), keep=["ordinal"])


class Steps:
    """A chain of named SQL steps, each reading the one before."""

    def __init__(self, first):
        self.steps, self.last = [("s0", first)], "s0"

    def then(self, sql):
        name = f"s{len(self.steps)}"
        self.steps.append((name, sql.replace("@", self.last)))
        self.last = name
        return self

    def group_median(self, by, column, least=1):
        med = f"(SELECT {by} AS k, quantile_cont(CAST({column} AS DOUBLE), 0.5) AS med, count({column}) AS cnt FROM @ GROUP BY 1)"
        self.then(
            f"""SELECT s.* REPLACE (coalesce(CAST({column} AS DOUBLE), CASE WHEN cnt >= {least} THEN med END) AS {column})
                FROM @ s LEFT JOIN {med} ON s.{by} = k"""
        )
        return self.then(
            f"SELECT * REPLACE (coalesce({column}, (SELECT quantile_cont({column}, 0.5) FROM @)) AS {column}) FROM @"
        )

    def group_mode(self, by, column):
        modes = f"""(SELECT {by} AS k, {column} AS m FROM @ WHERE {column} IS NOT NULL GROUP BY 1, 2
            QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY count(*) DESC, {column}) = 1)"""
        return self.then(
            f"SELECT s.* REPLACE (coalesce({column}, m, 'Unknown') AS {column}) FROM @ s LEFT JOIN {modes} ON s.{by} = k"
        )

    def sql(self, select):
        chain = ", ".join(f"{n} AS ({q})" for n, q in self.steps)
        return f"WITH {chain} {select.replace('@', self.last)}"


def brand_sql(name):
    low = f"lower({name})"
    starts = " ".join(f"WHEN starts_with({low}, '{w}') THEN '{b}'" for w, b in fx.BRAND_WORDS.items())
    holds = " ".join(f"WHEN contains({low}, '{w}') THEN '{b}'" for w, b in fx.BRAND_WORDS.items())
    return f"CASE {starts} {holds} ELSE 'Other' END"


def known_sql(column, mapping):
    quoted = {k.replace("'", "''"): v for k, v in mapping.items()}
    cases = " ".join(f"WHEN '{k}' THEN {v if isinstance(v, int) else repr(v)}" for k, v in quoted.items())
    return f"coalesce({column}, CASE name {cases} END) AS {column}"


FIRST_BY_NAME_PRICE = "SELECT * FROM @ QUALIFY row_number() OVER (PARTITION BY name, price ORDER BY ordinal) = 1"


def cleaned_steps():
    steps = Steps(
        f"SELECT *, CAST(regexp_extract(url, 'p([0-9]+).html', 1) AS BIGINT) AS ordinal FROM ({CATALOG_FEATURES_SQL})"
    )
    steps.then(FIRST_BY_NAME_PRICE)
    steps.then(
        f"SELECT *, brand AS b, CASE brand WHEN 'Apple' THEN 'iOS' ELSE 'Android' END AS os FROM (SELECT *, {brand_sql('name')} AS brand FROM @)"
    )
    steps.then("SELECT *, coalesce(CAST(price AS DOUBLE), (SELECT quantile_cont(CAST(price AS DOUBLE), 0.5) FROM @)) AS p FROM @")
    steps.then(
        """SELECT s.*, CASE WHEN p <= e1 THEN 'Low' WHEN p <= e2 THEN 'Medium' ELSE 'High' END AS segment FROM @ s,
           (SELECT quantile_cont(p, 1.0::DOUBLE / 3) AS e1, quantile_cont(p, 2.0::DOUBLE / 3) AS e2 FROM @)"""
    )
    steps.group_median("segment", "ram", 3)
    words = " OR ".join(f"contains(lower(name), '{w}')" for w in fx.NON_PHONE_WORDS)
    steps.then(
        f"""SELECT * REPLACE (coalesce(refresh_rate, 60) AS refresh_rate, {known_sql('chipset', fx.CHIPSET_BY_NAME)},
            {known_sql('cpu', fx.CHIPSET_BY_NAME)}, {known_sql('camera_main_resolution', fx.CAMERA_BY_NAME)},
            {known_sql('screen_resolution', fx.RESOLUTION_BY_NAME)}, {known_sql('screen_tech', fx.SCREEN_TECH_BY_NAME)},
            {known_sql('battery_capacity', fx.BATTERY_BY_NAME)})
            FROM @ WHERE price IS NOT NULL AND name IS NOT NULL AND NOT ({words})"""
    )
    steps.then(
        """SELECT * REPLACE (coalesce(chipset, brand || ' Unknown Chip') AS chipset,
           coalesce(cpu, brand || ' Unknown CPU') AS cpu) FROM @"""
    )
    for c in catalog.NUMBERS:
        steps.group_median("brand", c)
    for c in catalog.TEXTS:
        steps.group_mode("brand", c)
    return steps


CLEANED = ["url", "name", "brand", "os", "price", *catalog.NUMBERS, *catalog.TEXTS]


@query("x2_clean_and_impute", cleaned_steps().sql(f"SELECT {', '.join(CLEANED)} FROM @"))
def _(spark, d):
    return catalog.clean_and_impute(_catalog_features(spark, d), ["ordinal"]).select(*CLEANED)


def feature_steps():
    steps = cleaned_steps()
    name = squeeze_sql(r"regexp_replace(regexp_replace(name, '\([^)]*\)', '', 'g'), '\[[^\]]*\]', '', 'g')")
    chipset = squeeze_sql(
        r"regexp_replace(regexp_replace(chipset, '\([^)]*\)', '', 'g'), '[^\p{L}\p{M}\p{N}_\s]', '', 'g')"
    )
    camera = r"list_max(list_transform(regexp_extract_all(camera_main_resolution, '\d+'), lambda x: CAST(x AS INTEGER)))"
    resolution = NORMAL_RESOLUTION.replace("resolution_text", "screen_resolution")
    steps.then(
        f"""SELECT * REPLACE ({name} AS name, {chipset} AS chipset, {camera} AS camera_main_resolution,
            {resolution} AS screen_resolution) FROM @"""
    )
    steps.then(FIRST_BY_NAME_PRICE)
    steps.then("SELECT * FROM @ WHERE brand NOT IN (SELECT brand FROM @ GROUP BY 1 HAVING count(*) < 8)")
    distance = {
        k: f"abs(split_part(screen_resolution, ' x ', 1)::DOUBLE - {w}) + abs(split_part(screen_resolution, ' x ', 2)::DOUBLE - {h})"
        for k, (w, h) in fx.K_RESOLUTIONS.items()
    }
    nearest = "list_min([" + ", ".join(f"{{'d': {e}, 'o': {i}, 'k': '{k}'}}" for i, (k, e) in enumerate(distance.items())) + "]).k"
    steps.then(
        f"""SELECT * REPLACE ({brand_sql('name')} AS brand), CASE WHEN price < 3000000 THEN 'Low' WHEN price < 8000000 THEN 'Medium'
            WHEN price < 15000000 THEN 'High' ELSE 'Premium' END AS price_category,
            CASE WHEN screen_resolution IS NULL THEN 'Unknown' ELSE {nearest} END AS screen_resolution_k,
            {chip_sql('chipset')} AS chip_model FROM @"""
    )
    return steps.then("SELECT * REPLACE (CASE brand WHEN 'Apple' THEN 'iOS' ELSE 'Android' END AS os) FROM @")


FEATURES = [*CLEANED, "price_category", "screen_resolution_k", "chip_model"]


def _features(spark, d):
    cleaned = catalog.clean_and_impute(_catalog_features(spark, d), ["ordinal"])
    return catalog.normalise(cleaned, ["ordinal"])


@query("x3_normalise_features", feature_steps().sql(f"SELECT {', '.join(FEATURES)} FROM @"))
def _(spark, d):
    return _features(spark, d).select(*FEATURES)


_KEPT_NUMBERS = ["price", *catalog.NUMBERS, "camera_main_resolution"]


def _encoded_sql():
    parts = [
        one_hot_sql("@", "ordinal", grouped_sql("@", "screen_tech", 20), "screen_tech_grouped"),
        one_hot_sql("@", "ordinal", grouped_sql("@", "brand", 10), "brand_grouped"),
        one_hot_sql("@", "ordinal", grouped_sql("@", "chip_model", 10), "chip_model_grouped"),
        one_hot_sql("@", "ordinal", "screen_resolution_k", "screen_resolution_k"),
        one_hot_sql("@", "ordinal", "os", "os"),
        one_hot_sql("@", "ordinal", "security", "security"),
        "SELECT ordinal, 'screen_size', TRY_CAST(screen_size AS DOUBLE) FROM @",
        "SELECT ordinal, 'price_category_encoded', CASE price_category WHEN 'Low' THEN 0.0 WHEN 'Medium' THEN 1.0 "
        "WHEN 'High' THEN 2.0 ELSE 3.0 END::DOUBLE FROM @",
        *[f"SELECT ordinal, '{c}', {c}::DOUBLE FROM @" for c in _KEPT_NUMBERS],
    ]
    return feature_steps().sql(union_all(parts))


@query("x4_encode_for_model", _encoded_sql())
def _(spark, d):
    features = hand_off(_features(spark, d), "model")
    return melted(catalog.encode_for_model(features), ["ordinal"])


# Headphone rows derived from part; an older file of each shop repeats some of them.
_HEADPHONES = {
    "source": "'shop_' || CAST(p_size % 3 AS STRING)",
    "url": "'https://shop.example/tai-nghe-' || CAST(p_partkey % 1500 AS STRING)",
    "name": "headphone_name",
    "price_raw": "price_text",
    "price_vnd": "CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size * 450000 AS BIGINT) END",
    "brand": "CASE WHEN p_partkey % 5 <> 0 THEN p_name END",
    "type": "CASE p_size % 4 WHEN 0 THEN 'over-ear' WHEN 1 THEN 'in-ear gaming' WHEN 2 THEN 'True Wireless' END",
    "is_gaming": "CAST(CASE WHEN p_size % 5 = 0 THEN 1 WHEN p_size % 5 = 1 THEN 0 END AS INTEGER)",
    "is_wireless": "CAST(0 AS INTEGER)",
    "has_mic": "CAST(CASE WHEN p_partkey % 3 = 0 THEN 1 END AS INTEGER)",
    "connection": "connection_text",
    "battery_life_hours": "CASE p_size % 3 WHEN 0 THEN CAST(p_size % 6 AS STRING) WHEN 1 THEN CAST(p_size AS STRING) || ' giờ' END",
    "weight_gram": "CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS STRING) || '.5' END",
    "driver_size_mm": "CASE WHEN p_size % 4 <> 1 THEN CAST(p_size % 12 AS STRING) END",
    "impedance_ohm": "CAST(p_size * 2 AS STRING)",
    "sensitivity_db": "CASE WHEN p_size % 5 = 0 THEN 'n/a' ELSE CAST(90 + p_size % 20 AS STRING) END",
    "has_anc": "CAST(CASE WHEN p_partkey % 4 = 0 THEN 1 END AS INTEGER)",
    "water_resistant": "CAST(p_partkey % 2 AS INTEGER)",
    "warranty_months": "CASE WHEN p_size % 7 > 0 THEN '12' END",
    "rating": "'4.5'",
    "num_reviews": "CAST(p_partkey % 300 AS STRING)",
}
_OPTIONAL = list(_HEADPHONES)[-8:]
SHOP_PREFIXES = ["shop_0", "shop_1", "shop_2"]


def _headphone_folder(spark, d):
    folder = scratch_path(spark, "headphones")
    found = spec_texts(spark, d).select(
        "p_partkey", "p_size", *[F.expr(e).alias(n) for n, e in _HEADPHONES.items()]
    )
    for shop in range(3):
        mine = found.where(F.col("p_size") % 3 == shop)
        for stamp, rows_ in (("20240101", mine.where("p_partkey % 2 = 0")), ("20240301", mine)):
            # A single sorted file per shop keeps "first" the same in both engines' eyes.
            ordered = rows_.repartitionByRange(4, "p_partkey").sortWithinPartitions("p_partkey")
            # The shops' files differ in order: the last one's columns come from behind.
            names = [*fx.HEADPHONE_COLUMNS, *_OPTIONAL]
            writers.write_fixed(ordered, f"{folder}/shop_{shop}_{stamp}_080000", names[::-1] if shop == 2 else names)
    return folder


def headphone_steps():
    cells = ", ".join(f"{e} AS {n}" for n, e in _HEADPHONES.items())
    s = Steps(f"SELECT p_partkey, p_size, {cells} FROM {TEXTS}")
    s.then("SELECT * FROM @ QUALIFY row_number() OVER (PARTITION BY url ORDER BY p_size % 3, p_partkey) = 1")
    s.then("SELECT * FROM @ WHERE price_vnd IS NOT NULL AND (brand IS NOT NULL OR type IS NOT NULL)")
    s.then(
        """SELECT * REPLACE (coalesce(is_gaming, 0) AS is_gaming, coalesce(has_mic, 0) AS has_mic,
           TRY_CAST(battery_life_hours AS DOUBLE) AS battery_life_hours, TRY_CAST(weight_gram AS DOUBLE) AS weight_gram,
           coalesce(has_anc, 0) AS has_anc, coalesce(water_resistant, 0) AS water_resistant,
           TRY_CAST(driver_size_mm AS DOUBLE) AS driver_size_mm, TRY_CAST(impedance_ohm AS DOUBLE) AS impedance_ohm,
           TRY_CAST(sensitivity_db AS DOUBLE) AS sensitivity_db, TRY_CAST(warranty_months AS DOUBLE) AS warranty_months,
           TRY_CAST(rating AS DOUBLE) AS rating, TRY_CAST(num_reviews AS DOUBLE) AS num_reviews,
           CASE WHEN trim(connection) = '' OR length(trim(connection)) > 20 THEN NULL WHEN contains(connection, '3.5') THEN '3.5mm'
             WHEN regexp_matches(lower(connection), 'type c|usb.c') THEN 'Type C' WHEN starts_with(lower(trim(connection)), 'usb') THEN 'USB-A'
             WHEN regexp_matches(lower(connection), 'bluetooth|wireless') THEN 'Bluetooth' END AS connection)
           FROM @"""
    )
    s.then("SELECT * FROM @ WHERE price_vnd BETWEEN 100000 AND 20000000")
    s.then(
        """SELECT * REPLACE (CAST(coalesce(connection = 'Bluetooth', false) AS INTEGER) AS is_wireless,
             greatest(is_gaming, CAST(coalesce(contains(lower(type), 'gaming'), false) AS INTEGER)) AS is_gaming),
           CAST(coalesce(regexp_matches(lower(type), 'true wireless|tws'), false) AS INTEGER) AS is_tws,
           price_vnd / 1e6 / nullif(battery_life_hours, 0) AS price_per_battery_hour,
           price_vnd / 1e6 / nullif(driver_size_mm, 0) AS price_per_driver_mm FROM @"""
    )
    return s


_HEADPHONE_NUMBERS = [
    "price_vnd", "is_gaming", "is_wireless", "has_mic", "is_tws", "battery_life_hours", "weight_gram",
    "price_per_battery_hour", "price_per_driver_mm", *_OPTIONAL,
]


@query(
    "x5_headphone_table",
    headphone_steps().sql(
        "SELECT url, feature, round(value, 9) AS value FROM ("
        + union_all(
            [
                one_hot_sql("@", "url", grouped_sql("@", "brand", 15), "brand_grouped"),
                one_hot_sql("@", "url", "type", "type"),
                *[f"SELECT url, '{c}', {c}::DOUBLE FROM @" for c in _HEADPHONE_NUMBERS],
            ]
        )
        + ")"
    ),
)
def _(spark, d):
    encoded = headphones.headphone_table(spark, _headphone_folder(spark, d), SHOP_PREFIXES)
    numeric = encoded.drop("source", "name", "price_raw", "brand", "connection")
    return rounded(melted(numeric, ["url"]), ["value"], 9)


_HEADPHONE_TEXTS = ["url", "source", "name", "price_raw", "brand", "connection"]


# The rows come from CSV files, where an empty cell is a missing value.
@query(
    "x5_headphone_texts",
    headphone_steps().sql("SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in _HEADPHONE_TEXTS) + " FROM @"),
)
def _(spark, d):
    return headphones.headphone_table(spark, _headphone_folder(spark, d), SHOP_PREFIXES).select(*_HEADPHONE_TEXTS)


_REPORT_COLUMNS = ["p_brand", "p_type", "p_size", "p_retailprice"]
_REPORT_NUMBERS = ["p_retailprice", "p_size", "p_partkey"]


def _report_sql():
    def part(section, item, metric, value, tail=f" FROM {PART_GAPS}"):
        return f"SELECT '{section}' AS section, {item} AS item, '{metric}' AS metric, round(({value})::DOUBLE, 4) AS value{tail}"

    out = []
    for c in _REPORT_COLUMNS:
        out.append(part("distinct", f"'{c}'", "n_distinct", f"count(DISTINCT {c})"))
        out.append(part("missing", f"'{c}'", "n_missing", f"count(*) - count({c})"))
        out.append(part("missing", f"'{c}'", "percent", f"round_even((count(*) - count({c}))::DOUBLE / count(*) * 100 * 100, 0) / 100"))
    for c in _REPORT_NUMBERS:
        v = f"{c}::DOUBLE"
        for metric, e in {
            "n_present": f"count({c})", "mean": f"avg({v})", "std": f"stddev_samp({v})", "min": f"min({v})",
            "p25": f"quantile_cont({v}, 0.25)", "p50": f"quantile_cont({v}, 0.5)", "p75": f"quantile_cont({v}, 0.75)",
            "max": f"max({v})",
        }.items():
            out.append(part("describe", f"'{c}'", metric, e))
        out += [part("correlation", f"'{c}~{o}'", "r", f"corr({c}, {o})") for o in _REPORT_NUMBERS]
    medians = f"""(SELECT p_brand, quantile_cont(p_retailprice, 0.5) AS m FROM {PART_GAPS} WHERE p_brand IS NOT NULL
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15)"""
    out.append(part("brand_median", "p_brand", "median_value", "m", f" FROM {medians}"))
    top = f"(SELECT p_brand FROM {PART_GAPS} WHERE p_brand IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10)"
    boxed = f"""(SELECT s.p_brand, p_retailprice AS v, q1, q2, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
        FROM {PART_GAPS} s JOIN (SELECT p_brand, quantile_cont(p_retailprice, 0.25) AS q1, quantile_cont(p_retailprice, 0.5) AS q2,
          quantile_cont(p_retailprice, 0.75) AS q3 FROM {PART_GAPS} WHERE p_brand IN {top} GROUP BY 1) q USING (p_brand)
        WHERE p_retailprice IS NOT NULL)"""
    for metric, e in {
        "low_whisker": "min(v) FILTER (WHERE v BETWEEN lo AND hi)", "q1": "min(q1)", "median": "min(q2)", "q3": "min(q3)",
        "high_whisker": "max(v) FILTER (WHERE v BETWEEN lo AND hi)", "n_outliers": "count(*) FILTER (WHERE v NOT BETWEEN lo AND hi)",
    }.items():
        out.append(part("brand_box", "p_brand", metric, e, f" FROM {boxed} GROUP BY p_brand"))
    return f"SELECT * FROM ({union_all(out)}) WHERE NOT (section = 'missing' AND value = 0)"


@query("x6_price_report", _report_sql())
def _(spark, d):
    made = report.price_report(
        part_with_gaps(spark, d), "p_retailprice", "p_brand", _REPORT_NUMBERS, _REPORT_COLUMNS
    )
    return rounded(made, ["value"], 4)


def calls_from_events(spark, d):
    """Events in the shape of emergency calls."""
    return table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("zip"),
        F.concat(F.col("event_type"), F.lit(": "), "props").alias("title"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timeStamp"),
        F.when(F.col("event_id") % 9 != 0, F.concat(F.lit("T"), (F.col("user_id") % 20).cast("string"))).alias("twp"),
    )


_CALLS = """(SELECT CAST(user_id AS VARCHAR) AS zip, event_type || ': ' || props AS title, event_type AS reason, ts,
   CASE WHEN event_id % 9 <> 0 THEN 'T' || (user_id % 20) END AS twp FROM events)"""


def _calendar_sql():
    wd, day = "strftime(ts, '%a')", "strftime(ts, '%Y-%m-%d')"
    month, hour = "CAST(month(ts) AS VARCHAR)", "CAST(hour(ts) AS VARCHAR)"

    def view(name, a, b="NULL", counted="*"):
        return f"SELECT '{name}' AS view, {a} AS key_1, CAST({b} AS VARCHAR) AS key_2, count({counted}) AS n FROM {_CALLS} GROUP BY 2, 3"

    def top(name, c):
        return f"SELECT * FROM ({view(name, c)} HAVING {c} IS NOT NULL ORDER BY n DESC, key_1 LIMIT 5)"

    return union_all(
        [
            top("top_zip", "zip"),
            top("top_township", "twp"),
            f"SELECT 'distinct_titles', NULL, NULL, count(DISTINCT title) FROM {_CALLS}",
            view("reason", "reason"),
            view("weekday_reason", wd, "reason"),
            view("month_reason", month, "reason"),
            view("month", month, counted="twp"),
            view("day", day, counted="twp"),
            view("day_reason", day, "reason", "twp"),
            view("weekday_hour", wd, hour),
            view("weekday_month", wd, month),
        ]
    )


@query("x7_call_calendar", _calendar_sql())
def _(spark, d):
    return calls.call_calendar(calls_from_events(spark, d))


def _shop_sql():
    """Expected headphone rows of the three derived shops, in closed form."""
    shop = f"(p_partkey // {LISTING_SIZE} % 3)"
    over, traits0 = f"({shop} = 0 AND {_NO_PRICE})", "CAST(0 AS INTEGER)"
    return f"""SELECT CASE {shop} WHEN 0 THEN 'links' WHEN 1 THEN 'blocks' ELSE 'cards' END AS source,
        'https://shop.example' || {PRODUCT_PATH} AS url, p_name || ' R&D' AS name,
        CASE WHEN {over} THEN (1 + p_size) * 1000000 + (200 + p_size) * 1000
          WHEN {_NO_PRICE} THEN 0 ELSE (1 + p_size) * 1000000 + (100 + p_size) * 1000 END::BIGINT AS price_vnd,
        CASE WHEN {over} THEN {_FIRST_BRAND} WHEN {shop} > 0 THEN coalesce(nullif({_BRAND}, ''), regexp_extract(p_name, '[a-z]{{3,}}')) END AS brand,
        CASE WHEN {over} OR {shop} > 0 THEN '' END AS type,
        CASE WHEN {over} OR {shop} > 0 THEN {traits0} END AS is_gaming,
        CASE WHEN {over} THEN {_CONNECTION} WHEN {shop} > 0 THEN nullif({_CONNECTION}, '') END AS connection,
        CASE WHEN {shop} > 0 THEN {_HOURS} END AS battery_life_hours,
        CASE WHEN {over} OR {shop} > 0 THEN {GRAMS} END AS weight_gram FROM {TEXTS}"""


@query("x8_pages_to_products", _shop_sql())
def _(spark, d):
    base, host = "https://shop.example", "shop.example"
    listing = hand_off(listing_pages(spark, d), "listing")
    # Every listing page appears again later, as search results repeat products.
    pages = listing.unionByName(listing.withColumn("page_no", F.col("page_no") + 1_000_000))
    pages_of = detail_pages(spark, d).withColumn("shop", F.floor(F.col("p_partkey") / LISTING_SIZE) % 3)

    def details(shop):
        return pages_of.where(F.col("shop") == shop).select("url", "html")

    keep = ("page_no",)
    links = pg.listing_rows_from_links(pages.where("shop = 'links'"), "links", base, host, keep=keep)
    blocks = pg.listing_rows_from_cards(pages.where("shop = 'blocks'"), "blocks", base, pg.BLOCK_LAYOUT, keep=keep)
    cards = pg.listing_rows_from_cards(pages.where("shop = 'cards'"), "cards", base, pg.CARD_LAYOUT, keep=keep)
    made = rows.union_by_name(
        [
            shops.product_rows(links, details(0), True, ["page_no"]),
            shops.product_rows(blocks, details(1), False, ["page_no"]),
            shops.product_rows(cards, details(2), False, ["page_no"]),
        ]
    )
    return made.select(
        "source", "url", "name", "price_vnd", "brand", "type", "is_gaming", "connection", "battery_life_hours", "weight_gram"
    )


