"""Group-wise bands and fills (W)."""

from pyspark.sql import functions as F

from shelfwise.fixed_values import SEGMENT_LABELS
from shelfwise.operators import impute
from shelfwise.queries import query
from shelfwise.queries.sql import PART_GAPS
from shelfwise.sources.tables import part_with_gaps, table

_MEDIAN_PRICE = f"(SELECT quantile_cont(p_retailprice, 0.5) FROM {PART_GAPS})"
_FILLED_PRICE = f"(SELECT * REPLACE (coalesce(p_retailprice, {_MEDIAN_PRICE}) AS p_retailprice) FROM {PART_GAPS})"


def _bands_sql(source, k, labels):
    edges = ", ".join(f"quantile_cont(p_retailprice, {i}.0::DOUBLE / {k}) AS e{i}" for i in range(1, k))
    cases = " ".join(f"WHEN p_retailprice <= e{i + 1} THEN '{labels[i]}'" for i in range(k - 1))
    return f"""(SELECT s.*, CASE WHEN p_retailprice IS NULL THEN NULL {cases} ELSE '{labels[-1]}' END AS segment
        FROM {source} s, (SELECT {edges} FROM {source}))"""


@query(
    "w1_quantile_bands",
    f"""SELECT b.p_partkey, b.segment AS band3, c.segment AS band4
        FROM {_bands_sql('part', 3, SEGMENT_LABELS)} b JOIN
        {_bands_sql('part', 4, ['Low', 'Medium', 'High', 'Premium'])} c USING (p_partkey)""",
)
def _(spark, d):
    part = table(spark, d, "part")
    three = impute.quantile_bands(part, "p_retailprice", SEGMENT_LABELS, "band3")
    four = impute.quantile_bands(three, "p_retailprice", ["Low", "Medium", "High", "Premium"], "band4")
    return four.select("p_partkey", "band3", "band4")


def _segmented(spark, d):
    filled = impute.fill_median(part_with_gaps(spark, d), "p_retailprice")
    return impute.quantile_bands(filled, "p_retailprice", SEGMENT_LABELS, "segment")


_SEG = _bands_sql(_FILLED_PRICE, 3, SEGMENT_LABELS)


def _group_median_sql(source, by, column, least=1):
    stats = f"""(SELECT {by} AS k, quantile_cont(CAST({column} AS DOUBLE), 0.5) AS med, count({column}) AS n
        FROM {source} GROUP BY 1)"""
    filled = f"""(SELECT s.*, coalesce(CAST({column} AS DOUBLE), CASE WHEN n >= {least} THEN med END) AS v
        FROM {source} s LEFT JOIN {stats} ON {by} = k)"""
    return f"(SELECT *, coalesce(v, (SELECT quantile_cont(v, 0.5) FROM {filled})) AS filled FROM {filled})"


@query(
    "w2_guarded_group_median",
    f"SELECT p_partkey, segment, filled AS p_size FROM {_group_median_sql(_SEG, 'segment', 'p_size', 3)}",
)
def _(spark, d):
    filled = impute.fill_group_medians(_segmented(spark, d), "segment", ["p_size"], min_values=3)
    return filled.select("p_partkey", "segment", "p_size")


@query(
    "w3_group_median",
    f"SELECT p_partkey, p_brand, round(filled, 6) AS p_retailprice FROM {_group_median_sql(PART_GAPS, 'p_brand', 'p_retailprice')}",
)
def _(spark, d):
    filled = impute.fill_group_medians(part_with_gaps(spark, d), "p_brand", ["p_retailprice"])
    return filled.select("p_partkey", "p_brand", F.round("p_retailprice", 6).alias("p_retailprice"))


@query(
    "w4_all_numeric_medians",
    f"""SELECT p_partkey, round(a.filled, 6) AS p_retailprice, b.filled AS p_size
        FROM {_group_median_sql(PART_GAPS, 'p_brand', 'p_retailprice')} a
        JOIN {_group_median_sql(PART_GAPS, 'p_brand', 'p_size')} b USING (p_partkey)""",
)
def _(spark, d):
    filled = impute.fill_group_medians(part_with_gaps(spark, d), "p_brand", ["p_retailprice", "p_size"])
    return filled.select("p_partkey", F.round("p_retailprice", 6).alias("p_retailprice"), "p_size")


_MODES = f"""(SELECT p_brand AS k, p_type AS m FROM {PART_GAPS} WHERE p_type IS NOT NULL AND p_brand IS NOT NULL
   GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) = 1)"""
_MODE_FILLED = f"""(SELECT p_partkey, p_brand, coalesce(p_type, m, CASE WHEN p_brand IS NOT NULL THEN 'Unknown' END) AS t
   FROM {PART_GAPS} LEFT JOIN {_MODES} ON p_brand = k)"""


@query(
    "w5_group_mode",
    f"""SELECT p_partkey, p_brand, coalesce(t, (SELECT t FROM {_MODE_FILLED} WHERE t IS NOT NULL GROUP BY 1
        ORDER BY count(*) DESC, t LIMIT 1), 'Unknown') AS p_type FROM {_MODE_FILLED}""",
)
def _(spark, d):
    return impute.fill_group_modes(part_with_gaps(spark, d), "p_brand", ["p_type"]).select(
        "p_partkey", "p_brand", "p_type"
    )


@query("w6_overall_median", f"SELECT p_partkey, round(p_retailprice, 6) AS p_retailprice FROM {_FILLED_PRICE}")
def _(spark, d):
    filled = impute.fill_median(part_with_gaps(spark, d), "p_retailprice")
    return filled.select("p_partkey", F.round("p_retailprice", 6).alias("p_retailprice"))


@query(
    "w9_constant_fill",
    f"""SELECT p_partkey, coalesce(p_size, 60) AS p_size, coalesce(p_type, 'Unknown') AS p_type,
        coalesce(p_brand, '') AS p_brand FROM {PART_GAPS}""",
)
def _(spark, d):
    filled = impute.fill_constant(part_with_gaps(spark, d), {"p_size": 60, "p_type": "Unknown", "p_brand": "", "gpu": 0})
    return filled.select("p_partkey", "p_size", "p_type", "p_brand")


@query(
    "w10_fill_from_column",
    f"SELECT p_partkey, coalesce(p_type, p_brand || ' Unknown Chip') AS p_type FROM {PART_GAPS}",
)
def _(spark, d):
    label = F.concat("p_brand", F.lit(" Unknown Chip"))
    return impute.fill_from_column(part_with_gaps(spark, d), "p_type", label).select("p_partkey", "p_type")
