"""Chart data (C)."""

from pyspark.sql import functions as F

from shelfwise.operators import aggregate as agg
from shelfwise.operators import charts
from shelfwise.queries import query
from shelfwise.queries.aggregates import rounded
from shelfwise.queries.sql import ORDERS_GAPS, union_all
from shelfwise.sources.tables import orders_with_gaps, table


def hist_sql(source, column, bins, limits=None):
    """Bins by definition: every value falls where its two edges say."""
    lo_hi = limits or f"SELECT min({column}) AS lo, max({column}) AS hi FROM {source}"
    return f"""SELECT b.i AS bin, b.low, b.high, count({column}) AS n FROM (
        SELECT i, lo + i * ((hi - lo) / k) AS low, CASE WHEN i = k - 1 THEN hi ELSE lo + (i + 1) * ((hi - lo) / k) END AS high,
          i = k - 1 AS last FROM (SELECT lo, hi, k, unnest(range(k)) AS i FROM (SELECT lo, hi, {bins} AS k FROM ({lo_hi})))) b
        LEFT JOIN {source} s ON {column} >= b.low AND ({column} < b.high OR (b.last AND {column} <= b.high))
        GROUP BY 1, 2, 3"""


def rounded_edges(sql, extra=""):
    return f"SELECT {extra} bin, round(low, 6) AS low, round(high, 6) AS high, n FROM ({sql})"


@query("c1_histogram", rounded_edges(hist_sql(ORDERS_GAPS, "o_totalprice", 30)))
def _(spark, d):
    return rounded(charts.histogram(orders_with_gaps(spark, d), "o_totalprice", 30), ["low", "high"])


_AUTO = f"""(SELECT CAST(ceil((hi - lo) / CASE WHEN fd > 0 THEN least(fd, st) ELSE st END) AS BIGINT) FROM (
   SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi,
     (max(o_totalprice) - min(o_totalprice)) / (log2(count(o_totalprice)) + 1) AS st,
     2 * (quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25)) / pow(count(o_totalprice), 1.0::DOUBLE / 3) AS fd
   FROM {ORDERS_GAPS}))"""


@query("c2_automatic_histogram", rounded_edges(hist_sql(ORDERS_GAPS, "o_totalprice", _AUTO)))
def _(spark, d):
    return rounded(charts.automatic_histogram(orders_with_gaps(spark, d), "o_totalprice"), ["low", "high"])


@query(
    "c3_density",
    f"""SELECT CAST(i AS BIGINT) AS point, round(x, 6) AS x, round(sum(exp(-((v - x) / h) * ((v - x) / h) / 2)) / (n * h * sqrt(2 * pi())) * 1e6, 6) AS density
        FROM (SELECT o_totalprice / 1000 AS v FROM {ORDERS_GAPS} WHERE o_totalprice IS NOT NULL),
          (SELECT n, h, i, lo + i * (hi - lo) / 199 AS x FROM (SELECT count(*) AS n, min(o_totalprice / 1000) AS lo,
            max(o_totalprice / 1000) AS hi, stddev_samp(o_totalprice / 1000) * pow(count(*), -0.2) AS h
            FROM {ORDERS_GAPS} WHERE o_totalprice IS NOT NULL), (SELECT unnest(range(200)) AS i))
        GROUP BY i, x, n, h""",
)
def _(spark, d):
    orders = orders_with_gaps(spark, d).select((F.col("o_totalprice") / 1000).alias("thousands"))
    curve = charts.density(orders, "thousands")
    return rounded(curve.withColumn("density", F.col("density") * 1e6), ["x", "density"])


_LIMITS = f"SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM {ORDERS_GAPS}"
_CLEANED = f"(SELECT * FROM {ORDERS_GAPS} WHERE o_totalprice BETWEEN 100000 AND 300000)"


@query(
    "c4_before_after",
    rounded_edges(hist_sql(ORDERS_GAPS, "o_totalprice", 20, _LIMITS), "'before' AS stage,")
    + " UNION ALL "
    + rounded_edges(hist_sql(_CLEANED, "o_totalprice", 20, _LIMITS), "'after' AS stage,"),
)
def _(spark, d):
    orders = orders_with_gaps(spark, d)
    cleaned = orders.where(F.col("o_totalprice").between(1e5, 3e5))
    return rounded(charts.before_after(orders, cleaned, "o_totalprice", 20), ["low", "high"])


# A column with a long right tail, so that there are outliers to report.
_TAIL = "l_extendedprice * l_extendedprice * l_extendedprice * l_extendedprice / 1e12"
_LINES = f"""(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, {_TAIL} AS v FROM lineitem)"""
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _lines(spark, d):
    price = F.col("l_extendedprice")
    return table(spark, d, "lineitem").select(
        *KEYS, "l_returnflag", "l_linestatus", (price * price * price * price / 1e12).alias("v")
    )


def fenced_sql(by):
    keys = "".join(f"{k}, " for k in by)
    on = " AND ".join(f"l.{k} = f.{k}" for k in by) or "true"
    return f"""(SELECT l.*, q1, median, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM {_LINES} l JOIN
        (SELECT {keys} quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
         FROM {_LINES} {'GROUP BY ' + ', '.join(by) if by else ''}) f ON {on})"""


def box_sql(by):
    keys = "".join(f"{k}, " for k in by)
    return f"""SELECT {keys} round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
        round(min(v) FILTER (WHERE v BETWEEN lo AND hi), 4) AS low_whisker,
        round(max(v) FILTER (WHERE v BETWEEN lo AND hi), 4) AS high_whisker,
        count(*) FILTER (WHERE NOT v BETWEEN lo AND hi) AS n_outliers, count(*) AS n
        FROM {fenced_sql(by)} GROUP BY {keys} q1, median, q3"""


BOX = ["q1", "median", "q3", "low_whisker", "high_whisker"]


@query("c5_box_stats", box_sql([]))
def _(spark, d):
    return rounded(charts.box_stats(_lines(spark, d), "v"), BOX, 4)


@query("c6_box_stats_by_group", box_sql(["l_returnflag"]))
def _(spark, d):
    return rounded(charts.box_stats(_lines(spark, d), "v", ["l_returnflag"]), BOX, 4)


@query("c7_box_stats_by_two_keys", box_sql(["l_returnflag", "l_linestatus"]))
def _(spark, d):
    return rounded(charts.box_stats(_lines(spark, d), "v", ["l_returnflag", "l_linestatus"]), BOX, 4)


@query(
    "c8_outlier_rows",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, round(v, 4) AS v
        FROM {fenced_sql(['l_returnflag'])} WHERE v < lo OR v > hi""",
)
def _(spark, d):
    rows = charts.outliers(_lines(spark, d), "v", ["l_returnflag"]).drop("l_linestatus")
    return rounded(rows, ["v"], 4)


PAIRS = [("l_quantity", "l_extendedprice"), ("l_discount", "l_tax"), ("l_tax", "l_quantity")]
_FIT_LINES = "(SELECT * REPLACE (CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity END AS l_quantity) FROM lineitem)"


def fits_sql(by, source=_FIT_LINES, pairs=PAIRS):
    keys = "".join(f"{k}, " for k in by)
    return union_all(
        f"""SELECT {keys} '{x}' AS x, '{y}' AS y, round(regr_slope({y}, {x}), 6) AS slope,
            round(regr_intercept({y}, {x}), 5) AS intercept, round(regr_r2({y}, {x}), 6) AS r2,
            CAST(regr_count({y}, {x}) AS BIGINT) AS n FROM {source} {'GROUP BY ' + ', '.join(by) if by else ''}"""
        for x, y in pairs
    )


def _fit_lines(spark, d):
    quantity = F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity"))
    return table(spark, d, "lineitem").withColumn("l_quantity", quantity)


def rounded_fits(df):
    return rounded(rounded(df, ["slope", "r2"]), ["intercept"], 5)


@query("c9_linear_fits", fits_sql([]))
def _(spark, d):
    return rounded_fits(charts.linear_fits(_fit_lines(spark, d), PAIRS))


@query("c10_linear_fits_by_group", fits_sql(["l_returnflag"]))
def _(spark, d):
    return rounded_fits(charts.linear_fits(_fit_lines(spark, d), PAIRS, ["l_returnflag"]))


@query(
    "c11_fit_on_counts",
    fits_sql([], "(SELECT month(o_orderdate)::DOUBLE AS month, count(*) AS n_orders FROM orders GROUP BY 1)", [("month", "n_orders")]),
)
def _(spark, d):
    months = table(spark, d, "orders").groupBy(F.month("o_orderdate").alias("month")).agg(
        F.count("*").alias("n_orders")
    )
    return rounded_fits(charts.linear_fits(months, [("month", "n_orders")]))


@query(
    "c12_scatter_pairs",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_quantity AS x, l_extendedprice AS y
       FROM lineitem""",
)
def _(spark, d):
    return charts.scatter(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", [*KEYS, "l_returnflag"])


@query(
    "c13_bar_counts",
    "SELECT p_name AS value, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, value LIMIT 12",
)
def _(spark, d):
    return charts.bars(table(spark, d, "part"), "p_name", 12)


@query(
    "c14_count_series",
    f"""SELECT strftime(o_orderdate, '%Y-%m') AS month, count(o_custkey) AS n FROM {ORDERS_GAPS}
        GROUP BY 1 ORDER BY 1""",
)
def _(spark, d):
    orders = orders_with_gaps(spark, d).withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    return charts.series(orders, "month", "o_custkey")


@query(
    "c15_heat_map",
    "SELECT strftime(ts, '%a') AS weekday, "
    + ", ".join(f'nullif(count(event_type) FILTER (WHERE hour(ts) = {h}), 0) AS "{h}"' for h in range(24))
    + " FROM events GROUP BY 1",
)
def _(spark, d):
    from shelfwise.functions.numeric import weekday_name

    events = table(spark, d, "events").select(
        weekday_name("ts").alias("weekday"), F.hour("ts").alias("hour"), "event_type"
    )
    return agg.pivot_counts(events, "weekday", "hour", range(24), "event_type")
