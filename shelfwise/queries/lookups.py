"""Look-ups and joins (J)."""

from pyspark.sql import functions as F

from shelfwise import fixed_values as fx
from shelfwise.functions.numeric import WEEKDAY_NAMES
from shelfwise.operators import aggregate as agg
from shelfwise.operators import lookup, rows
from shelfwise.queries import query
from shelfwise.queries.sql import PART_GAPS
from shelfwise.sources.tables import part_with_gaps, table

BRAND_BY_NAME = {"red plate": "Brand#91", "hot ring": "Brand#92", "old rod": "Brand#93", "blue ring": "Brand#94"}

_CASE = "CASE p_name " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in BRAND_BY_NAME.items()) + " END"


@query("j1_dictionary_backfill", f"SELECT p_partkey, p_name, coalesce(p_brand, {_CASE}) AS p_brand FROM {PART_GAPS}")
def _(spark, d):
    parts = part_with_gaps(spark, d).select("p_partkey", "p_name", "p_brand")
    return lookup.backfill(parts, "p_name", "p_brand", BRAND_BY_NAME)


@query(
    "j2_value_map",
    """SELECT event_id, strftime(ts, '%a') AS weekday,
       CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'purchase' THEN 2 END AS stage FROM events""",
)
def _(spark, d):
    return table(spark, d, "events").select(
        "event_id",
        lookup.mapped(F.weekday("ts"), dict(enumerate(WEEKDAY_NAMES))).alias("weekday"),
        lookup.mapped("event_type", {"click": 0, "view": 1, "purchase": 2}).alias("stage"),
    )


@query(
    "j3_keep_top_members",
    """SELECT p_partkey, p_brand FROM part WHERE p_brand IN (
       SELECT p_brand FROM part GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 10)""",
)
def _(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    return lookup.keep_members(part, "p_brand", agg.top_values(part, "p_brand", 10))


@query(
    "j4_drop_rare_members",
    """SELECT p_partkey, p_name FROM part WHERE p_name NOT IN (
       SELECT p_name FROM part GROUP BY 1 HAVING count(*) < 30)""",
)
def _(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_name")
    return lookup.drop_members(part, "p_name", agg.rare_values(part, "p_name", 30))


@query(
    "j5_attach_by_key",
    """SELECT o_orderkey, o_totalprice, s.n_lines, s.qty FROM orders LEFT JOIN
       (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty FROM lineitem GROUP BY 1) s
       ON o_orderkey = l_orderkey""",
)
def _(spark, d):
    lines = (
        table(spark, d, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count("*").alias("n_lines"), F.sum("l_quantity").alias("qty"))
    )
    return lookup.attach_by_key(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), lines, "o_orderkey")


_K_VALUES = ", ".join(f"({i}, '{k}', {w}, {h})" for i, (k, (w, h)) in enumerate(fx.K_RESOLUTIONS.items()))


@query(
    "j6_nearest_resolution",
    f"""SELECT p_partkey, coalesce(arg_min(k, dist * 100 + i), 'Unknown') AS screen_resolution_k FROM (
        SELECT p_partkey, k, i, abs(p_size * 160 - w) + abs(p_size * 90 - h) AS dist
        FROM {PART_GAPS}, (VALUES {_K_VALUES}) AS refs(i, k, w, h)) GROUP BY p_partkey""",
)
def _(spark, d):
    size = F.col("p_size")
    return part_with_gaps(spark, d).select(
        "p_partkey", lookup.nearest([size * 160, size * 90], fx.K_RESOLUTIONS).alias("screen_resolution_k")
    )


_PHONE_NAMES = """(SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'Redmi ' || p_name
   WHEN 1 THEN 'Điện thoại SAMSUNG ' || p_name WHEN 2 THEN 'Apple ' || p_name || ' for Sony'
   WHEN 3 THEN p_name || ' moto blu' ELSE p_name END AS name FROM part)"""


def phone_names(spark, d):
    name, kind = F.col("p_name"), F.col("p_partkey") % 5
    return table(spark, d, "part").select(
        "p_partkey",
        F.when(kind == 0, F.concat(F.lit("Redmi "), name))
        .when(kind == 1, F.concat(F.lit("Điện thoại SAMSUNG "), name))
        .when(kind == 2, F.concat(F.lit("Apple "), name, F.lit(" for Sony")))
        .when(kind == 3, F.concat(name, F.lit(" moto blu")))
        .otherwise(name)
        .alias("name"),
    )


_RULES = ", ".join(f"({i}, '{w}', '{b}')" for i, (w, b) in enumerate(fx.BRAND_WORDS.items()))


@query(
    "j7_brand_rules",
    f"""SELECT p_partkey, coalesce(arg_min(brand, CASE WHEN starts_with(lower(name), word) THEN i
          WHEN contains(lower(name), word) THEN 1000 + i END), 'Other') AS brand
        FROM {_PHONE_NAMES}, (VALUES {_RULES}) AS rules(i, word, brand) GROUP BY p_partkey""",
)
def _(spark, d):
    return phone_names(spark, d).select("p_partkey", lookup.by_ordered_words("name", fx.BRAND_WORDS).alias("brand"))


@query(
    "j8_upsert_latest",
    """SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (
       PARTITION BY user_id ORDER BY CASE WHEN event_type = 'error' THEN 1 ELSE 0 END, event_id DESC) = 1""",
)
def _(spark, d):
    events = table(spark, d, "events").select("user_id", "event_id", "event_type", "value")
    return rows.upsert_latest(events, "user_id", F.col("event_type") == "error", "event_id")


_KEYED = """(SELECT event_id, CAST(user_id AS VARCHAR) || props AS url, ts < TIMESTAMP '2024-01-16' AS early FROM events)"""


@query(
    "j9_unseen_keys",
    f"""SELECT url, min(event_id) AS event_id FROM {_KEYED} WHERE NOT early
        AND url NOT IN (SELECT url FROM {_KEYED} WHERE early) GROUP BY url""",
)
def _(spark, d):
    keyed = table(spark, d, "events").select(
        "event_id",
        F.concat(F.col("user_id").cast("string"), "props").alias("url"),
        (F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")).alias("early"),
    )
    batch = rows.keep_first(keyed.where(~F.col("early")).select("url", "event_id"), ["url"], ["event_id"])
    return lookup.unseen(batch, keyed.where("early"), "url")
