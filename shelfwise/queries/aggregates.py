"""Counts, profiles, correlation and pivots (A)."""

from pyspark.sql import functions as F

from shelfwise.operators import aggregate as agg
from shelfwise.operators.quantiles import exact_quantiles
from shelfwise.queries import query
from shelfwise.queries.sql import ORDERS_GAPS, PART_GAPS, union_all
from shelfwise.sources.tables import orders_with_gaps, part_with_gaps, table

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
ORDER_COLUMNS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
PART_COLUMNS = ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def rounded(df, columns, places=6):
    return df.select(*[F.round(c, places).alias(c) if c in columns else F.col(c) for c in df.columns])


@query(
    "a1_value_counts",
    f"""SELECT o_orderpriority AS value, count(*) AS n FROM {ORDERS_GAPS}
        WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY n DESC, value""",
)
def _(spark, d):
    return agg.value_counts(orders_with_gaps(spark, d), "o_orderpriority")


@query("a2_value_counts_with_missing", f"SELECT p_brand AS value, count(*) AS n FROM {PART_GAPS} GROUP BY 1")
def _(spark, d):
    return agg.value_counts(part_with_gaps(spark, d), "p_brand", keep_missing=True)


@query(
    "a3_counts_by_value",
    f"SELECT p_size AS value, count(*) AS n FROM {PART_GAPS} WHERE p_size IS NOT NULL GROUP BY 1 ORDER BY 1",
)
def _(spark, d):
    return agg.value_counts(part_with_gaps(spark, d), "p_size", by_value=True)


@query("a4_distinct_count", "SELECT count(DISTINCT user_id) AS n_users FROM events")
def _(spark, d):
    return table(spark, d, "events").agg(F.count_distinct("user_id").alias("n_users"))


@query(
    "a5_distinct_counts",
    union_all(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM {ORDERS_GAPS}" for c in ORDER_COLUMNS
    ),
)
def _(spark, d):
    return agg.distinct_counts(orders_with_gaps(spark, d), ORDER_COLUMNS)


@query(
    "a6_describe",
    union_all(
        f"""SELECT '{c}' AS metric, count({c}) AS n_present, round(avg({c}), 6) AS mean,
            round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75 FROM lineitem"""
        for c in LINE_NUMBERS
    ),
)
def _(spark, d):
    return rounded(agg.describe(table(spark, d, "lineitem"), LINE_NUMBERS), ["mean", "std", "p25", "p50", "p75"])


@query(
    "a7_missing_profile",
    "SELECT column_name, n_missing, round_even(CAST(n_missing AS DOUBLE) / n * 100 * 100, 0) / 100 AS percent FROM ("
    + union_all(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_missing, count(*) AS n FROM {PART_GAPS}"
        for c in PART_COLUMNS
    )
    + ") WHERE n_missing > 0",
)
def _(spark, d):
    return agg.missing_profile(part_with_gaps(spark, d), PART_COLUMNS)


@query(
    "a8_missing_ratio",
    union_all(
        f"""SELECT '{c}' AS column_name,
            round(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)::DOUBLE / count(*), 9) AS missing_ratio FROM {PART_GAPS}"""
        for c in PART_COLUMNS
    ),
)
def _(spark, d):
    return rounded(agg.missing_ratio(part_with_gaps(spark, d), PART_COLUMNS), ["missing_ratio"], 9)


@query(
    "a9_missing_ratio_by_group",
    union_all(
        f"""SELECT '{g}' AS column_group, '{c}' AS column_name,
            round(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)::DOUBLE / count(*), 9) AS missing_ratio FROM {PART_GAPS}"""
        for g, c in [("price", "p_retailprice"), ("id", "p_brand"), ("id", "p_type"), ("spec", "p_size")]
    ),
)
def _(spark, d):
    groups = {"price": ["p_retailprice"], "id": ["p_brand", "p_type"], "spec": ["p_size", "weight_gram"]}
    return rounded(agg.missing_ratio_by_group(part_with_gaps(spark, d), groups), ["missing_ratio"], 9)


@query(
    "a10_conditional_count",
    f"""SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS n_final,
        count(*) FILTER (WHERE o_totalprice IS NULL) AS n_unpriced FROM {ORDERS_GAPS}""",
)
def _(spark, d):
    return agg.count_where(
        orders_with_gaps(spark, d),
        n_final=F.col("o_orderstatus") == "F",
        n_unpriced=F.col("o_totalprice").isNull(),
    )


@query(
    "a11_step_audit",
    f"""SELECT count(*) AS n_before, count(o_totalprice) AS n_after,
        count(*) - count(o_totalprice) AS n_removed FROM {ORDERS_GAPS}""",
)
def _(spark, d):
    return agg.step_audit(orders_with_gaps(spark, d), lambda rows: rows.where(F.col("o_totalprice").isNotNull()))


@query(
    "a12_present_counts_by_key",
    """SELECT month(o_orderdate) AS month, count(o_custkey) AS n_o_custkey,
       count(o_orderstatus) AS n_o_orderstatus, count(o_totalprice) AS n_o_totalprice
       FROM """ + ORDERS_GAPS + " GROUP BY 1",
)
def _(spark, d):
    orders = orders_with_gaps(spark, d).withColumn("month", F.month("o_orderdate").cast("long"))
    return agg.present_counts(orders, ["month"], ["o_custkey", "o_orderstatus", "o_totalprice"])


@query(
    "a13_counts_per_date",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(user_id) AS n
       FROM events GROUP BY 1, 2""",
)
def _(spark, d):
    events = table(spark, d, "events").withColumn("day", F.to_date("ts").cast("string"))
    return agg.count_by(events, ["day", "event_type"], "user_id")


@query(
    "a14_two_key_counts",
    """SELECT CAST(isodow(ts) - 1 AS INTEGER) AS weekday, event_type, count(*) AS n
       FROM events GROUP BY 1, 2""",
)
def _(spark, d):
    events = table(spark, d, "events").withColumn("weekday", F.weekday("ts"))
    return agg.count_by(events, ["weekday", "event_type"])


@query(
    "a15_ranked_group_medians",
    f"""SELECT p_brand, round(quantile_cont(p_retailprice, 0.5), 6) AS median_value, count(p_retailprice) AS n
        FROM {PART_GAPS} WHERE p_brand IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
)
def _(spark, d):
    return rounded(
        agg.ranked_group_medians(part_with_gaps(spark, d), "p_brand", "p_retailprice", 15), ["median_value"]
    )


@query(
    "a16_overall_median_mode",
    f"""SELECT round(quantile_cont(p_retailprice, 0.5), 6) AS median_value,
        (SELECT p_type FROM {PART_GAPS} WHERE p_type IS NOT NULL GROUP BY 1
         ORDER BY count(*) DESC, p_type LIMIT 1) AS mode_value FROM {PART_GAPS}""",
)
def _(spark, d):
    return rounded(
        agg.overall_median_and_mode(part_with_gaps(spark, d), "p_retailprice", "p_type"), ["median_value"]
    )


CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "fixed"]


def _lines(spark, d):
    """Line numbers with gaps on two columns and one column without spread."""
    return table(spark, d, "lineitem").select(
        "l_quantity",
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(F.col("l_partkey") % 5 != 0, F.col("l_discount")).alias("l_discount"),
        "l_tax",
        F.lit(1.0).alias("fixed"),
    )


_LINES = """(SELECT l_quantity, CASE WHEN l_orderkey % 7 <> 0 THEN l_extendedprice END AS l_extendedprice,
   CASE WHEN l_partkey % 5 <> 0 THEN l_discount END AS l_discount, l_tax, CAST(1 AS DOUBLE) AS fixed FROM lineitem)"""


def _corr_sql(a, b):
    return f"""SELECT '{a}' AS x, '{b}' AS y, CASE
        WHEN stddev_pop({a}) FILTER (WHERE {b} IS NOT NULL) > 0 AND stddev_pop({b}) FILTER (WHERE {a} IS NOT NULL) > 0
        THEN round(corr({a}, {b}), 6) END AS r FROM {_LINES}"""


@query("a17_correlation_matrix", union_all(_corr_sql(a, b) for a in CORR for b in CORR))
def _(spark, d):
    return rounded(agg.correlation_pairs(_lines(spark, d), CORR), ["r"])


@query(
    "a18_correlation_with_target",
    "SELECT x, r FROM ("
    + union_all(_corr_sql(a, "l_extendedprice") for a in CORR)
    + ") ORDER BY r DESC NULLS LAST, x LIMIT 4",
)
def _(spark, d):
    return rounded(agg.correlation_with(_lines(spark, d), "l_extendedprice", CORR, 4), ["r"])


@query("a19_correlation_lower", union_all(_corr_sql(a, b) for i, a in enumerate(CORR) for b in CORR[:i]))
def _(spark, d):
    return rounded(agg.correlation_lower(_lines(spark, d), CORR), ["r"])


@query(
    "a20_pivot_counts",
    "SELECT CAST(hour(ts) AS INTEGER) AS hour, "
    + ", ".join(f"nullif(count(user_id) FILTER (WHERE event_type = '{e}'), 0) AS {e}" for e in EVENT_TYPES)
    + " FROM events GROUP BY 1",
)
def _(spark, d):
    events = table(spark, d, "events").withColumn("hour", F.hour("ts"))
    return agg.pivot_counts(events, "hour", "event_type", EVENT_TYPES, "user_id")


@query(
    "a21_deviations",
    union_all(
        f"SELECT '{c}' AS column_name, round(stddev_samp({c}), 6) AS std FROM lineitem" for c in LINE_NUMBERS
    ),
)
def _(spark, d):
    return rounded(agg.deviations(table(spark, d, "lineitem"), LINE_NUMBERS), ["std"])


@query(
    "a22_frequency_rule",
    """SELECT p_name AS value, count(*) AS n, CASE WHEN count(*) >= 30 THEN 'frequent' ELSE 'rare' END AS kind
       FROM part GROUP BY 1""",
)
def _(spark, d):
    part = table(spark, d, "part")
    frequent = agg.frequent_values(part, "p_name", 30).withColumn("kind", F.lit("frequent"))
    rare = agg.rare_values(part, "p_name", 30).withColumn("kind", F.lit("rare"))
    return frequent.unionByName(rare)


@query(
    "a6_quantiles_narrowed",
    """SELECT l_returnflag, metric, count(*) AS n, round(quantile_cont(v, 0.1), 6) AS q0, round(quantile_cont(v, 0.5), 6) AS q1,
        round(quantile_cont(v, 0.999), 6) AS q2
        FROM (SELECT l_returnflag, 'l_extendedprice' AS metric, l_extendedprice::DOUBLE AS v FROM lineitem
              UNION ALL SELECT l_returnflag, 'l_quantity', l_quantity::DOUBLE FROM lineitem) GROUP BY ALL""",
)
def _(spark, d):
    """The path of large groups, taken for any size: edges are narrowed until few rows lie between."""
    found = exact_quantiles(
        table(spark, d, "lineitem"), ["l_extendedprice", "l_quantity"], [0.1, 0.5, 0.999], ["l_returnflag"], direct_rows=100, steps=50
    )
    return rounded(found.select("l_returnflag", "metric", "n", "q0", "q1", "q2"), ["q0", "q1", "q2"])
