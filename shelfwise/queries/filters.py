"""Projections, filters, ordering, unions and keep-first (P, K, U, D)."""

from pyspark.sql import functions as F

from shelfwise.functions import urls
from shelfwise.operators import aggregate as agg
from shelfwise.operators import rows
from shelfwise.queries import query
from shelfwise.queries.sql import ORDERS_GAPS, PART_GAPS, union_all
from shelfwise.sources.tables import orders_with_gaps, part_with_gaps, table

KEYWORDS = ["anvil", "hot ", "gizmo"]


@query("p1_column_subset", "SELECT p_partkey, p_name, p_retailprice FROM part")
def _(spark, d):
    return rows.pick(table(spark, d, "part"), ["p_partkey", "p_name", "p_retailprice"])


@query("p2_drop_present_columns", "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def _(spark, d):
    return rows.drop_present(table(spark, d, "part"), ["p_type", "p_size", "os_version", "gpu"])


@query(
    "p3_derived_column",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS charge FROM lineitem""",
)
def _(spark, d):
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return (
        table(spark, d, "lineitem")
        .withColumn("charge", F.round(charge, 6))
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "charge")
    )


@query("p4_columns_by_type", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(spark, d):
    orders = table(spark, d, "orders")
    return orders.select(*rows.numeric_columns(orders))


@query("p5_drop_constant_columns", "SELECT p_partkey, p_size, p_retailprice FROM part")
def _(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice", F.lit(1).alias("e"))
    return rows.drop_constant_columns(part)


@query(
    "p6_drop_missing_subset",
    f"""SELECT o_orderkey, o_totalprice, o_orderpriority FROM {ORDERS_GAPS}
        WHERE o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL""",
)
def _(spark, d):
    kept = rows.drop_missing(orders_with_gaps(spark, d), ["o_totalprice", "o_orderpriority"])
    return kept.select("o_orderkey", "o_totalprice", "o_orderpriority")


@query(
    "p7_drop_missing_any_all",
    f"""SELECT 'any' AS rule, o_orderkey FROM {ORDERS_GAPS}
        WHERE o_custkey IS NOT NULL AND o_orderstatus IS NOT NULL AND o_totalprice IS NOT NULL
          AND o_orderpriority IS NOT NULL
        UNION ALL SELECT 'all', o_orderkey FROM {ORDERS_GAPS}
        WHERE NOT (o_custkey IS NULL AND o_orderstatus IS NULL AND o_orderpriority IS NULL)""",
)
def _(spark, d):
    orders = orders_with_gaps(spark, d)
    complete = rows.drop_missing(orders, how="any")
    partial = rows.drop_missing(orders, ["o_custkey", "o_orderstatus", "o_orderpriority"], how="all")
    return complete.select(F.lit("any").alias("rule"), "o_orderkey").unionByName(
        partial.select(F.lit("all").alias("rule"), "o_orderkey")
    )


@query("p8_positive_filter", f"SELECT p_partkey, p_size FROM {PART_GAPS} WHERE p_size > 0")
def _(spark, d):
    return rows.positive(part_with_gaps(spark, d), "p_size").select("p_partkey", "p_size")


@query(
    "p9_range_filter",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 300000",
)
def _(spark, d):
    return rows.within(table(spark, d, "orders"), "o_totalprice", 1e5, 3e5).select(
        "o_orderkey", "o_totalprice"
    )


@query(
    "p10_completeness_rule",
    f"""SELECT p_partkey, p_brand, p_type, p_retailprice FROM {PART_GAPS}
        WHERE p_retailprice IS NOT NULL AND (p_brand IS NOT NULL OR p_type IS NOT NULL)""",
)
def _(spark, d):
    return rows.usable_products(part_with_gaps(spark, d), "p_retailprice", ["p_brand", "p_type"]).select(
        "p_partkey", "p_brand", "p_type", "p_retailprice"
    )


@query(
    "p11_keyword_exclusion",
    """SELECT p_partkey, p_name FROM part WHERE p_name IS NULL OR NOT (
        contains(lower(p_name), 'anvil') OR contains(lower(p_name), 'hot ')
        OR contains(lower(p_name), 'gizmo'))""",
)
def _(spark, d):
    return rows.without_keywords(table(spark, d, "part"), "p_name", KEYWORDS).select("p_partkey", "p_name")


@query("p12_equality_subset", "SELECT event_id, user_id FROM events WHERE event_type = 'click'")
def _(spark, d):
    return table(spark, d, "events").where(F.col("event_type") == "click").select("event_id", "user_id")


@query("p13_contains_ignoring_case", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%ring%'")
def _(spark, d):
    return rows.contains_ignoring_case(table(spark, d, "part"), "p_name", "RING").select(
        "p_partkey", "p_name"
    )


@query(
    "p14_missing_or_present_rows",
    f"""SELECT o_orderkey, CASE WHEN o_totalprice IS NULL THEN 'missing' ELSE 'present' END AS state
        FROM {ORDERS_GAPS}""",
)
def _(spark, d):
    orders = orders_with_gaps(spark, d)
    price = F.col("o_totalprice")
    return (
        orders.where(price.isNull())
        .select("o_orderkey", F.lit("missing").alias("state"))
        .unionByName(orders.where(price.isNotNull()).select("o_orderkey", F.lit("present").alias("state")))
    )


# The listing host and slugs of the rule, re-expressed over the given page addresses: every
# address becomes a product-like slug of its language folder.
_SLUG_SQL = """(SELECT page_id, CASE page_id % 6
   WHEN 0 THEN 'https://shop.example/thiet-bi-am-thanh/tai-nghe/jbl/' || page_id || '.html'
   WHEN 1 THEN 'https://shop.example/tai-nghe/' || page_id || '.html'
   WHEN 2 THEN 'https://shop.example/tai-nghe-chup-tai-' || page_id || '.html'
   WHEN 3 THEN 'https://shop.example/tai-nghe-khong-day-dai-' || page_id || '.html'
   WHEN 4 THEN 'https://shop.example/tai-nghe-' || page_id || '.html'
   ELSE url END AS url FROM pages)"""


def _shop_urls(spark, d):
    pages = table(spark, d, "pages")
    n = F.col("page_id").cast("string")
    kind = F.col("page_id") % 6
    base = "https://shop.example/"
    url = (
        F.when(kind == 0, F.concat(F.lit(base + "thiet-bi-am-thanh/tai-nghe/jbl/"), n, F.lit(".html")))
        .when(kind == 1, F.concat(F.lit(base + "tai-nghe/"), n, F.lit(".html")))
        .when(kind == 2, F.concat(F.lit(base + "tai-nghe-chup-tai-"), n, F.lit(".html")))
        .when(kind == 3, F.concat(F.lit(base + "tai-nghe-khong-day-dai-"), n, F.lit(".html")))
        .when(kind == 4, F.concat(F.lit(base + "tai-nghe-"), n, F.lit(".html")))
        .otherwise(F.col("url"))
    )
    return pages.select("page_id", url.alias("url"))


@query(
    "p15_product_url",
    f"""SELECT page_id, url, CASE
          WHEN NOT (contains(url, 'shop.example') AND contains(url, '.html')) THEN 0
          WHEN contains(p, '/thiet-bi-am-thanh/tai-nghe/') AND length(p) - length(replace(p, '/', '')) >= 2 THEN 0
          WHEN p LIKE 'tai-nghe/%' AND length(p) < 25 THEN 0
          WHEN contains(p, 'tai-nghe-chup-tai') OR contains(p, 'tai-nghe-bluetooth')
            OR contains(p, 'tai-nghe-gaming') THEN 1
          WHEN p LIKE 'tai-nghe-%.html' AND length(p) > 25 THEN 1 ELSE 0 END AS is_product
        FROM (SELECT *, trim(split_part(url, 'shop.example', 2), '/') AS p FROM {_SLUG_SQL})""",
)
def _(spark, d):
    found = urls.is_product_url("url", "shop.example")
    return _shop_urls(spark, d).select("page_id", "url", found.cast("int").alias("is_product"))


@query(
    "p17_lacking_value",
    f"SELECT p_partkey FROM {PART_GAPS} WHERE p_size IS NULL OR p_size = 0",
)
def _(spark, d):
    return rows.lacking(part_with_gaps(spark, d), "p_size").select("p_partkey")


@query(
    "p18_missing_mask",
    f"""SELECT o_orderkey, CAST(o_custkey IS NULL AS INTEGER) AS o_custkey,
        CAST(o_orderstatus IS NULL AS INTEGER) AS o_orderstatus,
        CAST(o_totalprice IS NULL AS INTEGER) AS o_totalprice FROM {ORDERS_GAPS}""",
)
def _(spark, d):
    return rows.missing_mask(
        orders_with_gaps(spark, d), ["o_custkey", "o_orderstatus", "o_totalprice"], keep=["o_orderkey"]
    )


@query("k1_single_key_sort", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC")
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return rows.ordered(orders, [F.desc("o_totalprice")], tie=["o_orderkey"])


@query(
    "k2_mixed_direction_sort",
    """SELECT o_orderstatus, o_totalprice, o_orderkey FROM orders
       ORDER BY o_orderstatus, o_totalprice DESC""",
)
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderstatus", "o_totalprice", "o_orderkey")
    return rows.ordered(orders, [F.asc("o_orderstatus"), F.desc("o_totalprice")], tie=["o_orderkey"])


@query(
    "k3_head",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return rows.top_rows(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 100)


@query(
    "k4_top_values",
    """SELECT p_brand AS value, count(*) AS n FROM part GROUP BY p_brand
       ORDER BY n DESC, value LIMIT 10""",
)
def _(spark, d):
    return agg.top_values(table(spark, d, "part"), "p_brand", 10)


@query(
    "k5_top_five_keys",
    """SELECT user_id AS value, count(*) AS n FROM events GROUP BY user_id
       ORDER BY n DESC, value LIMIT 5""",
)
def _(spark, d):
    return agg.top_values(table(spark, d, "events"), "user_id", 5)


@query(
    "k6_seeded_sample",
    "SELECT * FROM part ORDER BY md5('42:' || p_partkey), p_partkey LIMIT 5",
)
def _(spark, d):
    return rows.seeded_rows(table(spark, d, "part"), "p_partkey", 5)


@query("k7_item_cap", "SELECT page_id, url FROM pages ORDER BY page_id LIMIT 120")
def _(spark, d):
    return rows.top_rows(table(spark, d, "pages").select("page_id", "url"), [F.asc("page_id")], 120)


def _parties(spark, d):
    customers = table(spark, d, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, d, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")
    )
    return customers, suppliers


@query(
    "u1_union_by_name",
    union_all(
        [
            "SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer",
            "SELECT s_name, s_nationkey, NULL, s_acctbal FROM supplier",
        ]
    ),
)
def _(spark, d):
    return rows.union_by_name(_parties(spark, d))


@query(
    "u2_ranked_union",
    union_all(
        [
            "SELECT c_name AS name, c_nationkey AS nation, CAST(0 AS INTEGER) AS source_rank FROM customer",
            "SELECT s_name, s_nationkey, CAST(1 AS INTEGER) FROM supplier",
        ]
    ),
)
def _(spark, d):
    customers, suppliers = _parties(spark, d)
    both = [customers.drop("segment"), suppliers.drop("balance")]
    return rows.ranked_union(both)


_DOUBLED = """(SELECT 0 AS source_rank, page_id, url FROM pages
   UNION ALL SELECT 1, page_id + 100000, url FROM pages)"""


@query("d1_keep_first_url", f"""SELECT source_rank, page_id, url FROM {_DOUBLED}
   QUALIFY row_number() OVER (PARTITION BY url ORDER BY source_rank, page_id) = 1""")
def _(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    again = pages.withColumn("page_id", F.col("page_id") + 100000)
    return rows.keep_first(rows.ranked_union([pages, again]), ["url"], ["source_rank", "page_id"]).select(
        "source_rank", "page_id", "url"
    )


@query(
    "d2_keep_first_name_price",
    f"""SELECT p_name, p_retailprice, p_partkey, p_brand FROM {PART_GAPS}
        QUALIFY row_number() OVER (PARTITION BY p_name, p_retailprice ORDER BY p_partkey) = 1""",
)
def _(spark, d):
    parts = part_with_gaps(spark, d).select("p_name", "p_retailprice", "p_partkey", "p_brand")
    return rows.keep_first(parts, ["p_name", "p_retailprice"], ["p_partkey"])


@query("d3_full_row_distinct", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query(
    "w7_keep_first_in_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) = 1""",
)
def _(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    return rows.keep_first(lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


