"""Encoding and features (E)."""

from pyspark.sql import functions as F

from shelfwise import fixed_values as fx
from shelfwise.functions import phone as ph
from shelfwise.operators import encode, impute
from shelfwise.queries import query
from shelfwise.queries.lookups import _PHONE_NAMES, _RULES, phone_names
from shelfwise.queries.sql import PART_GAPS, union_all
from shelfwise.queries.texts import NORMAL_RESOLUTION, TEXTS
from shelfwise.sources.derived import spec_texts
from shelfwise.sources.tables import part_with_gaps, table


def top_sql(source, column, k):
    return f"""(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1
        ORDER BY count(*) DESC, {column} LIMIT {k})"""


def grouped_sql(source, column, k):
    return f"CASE WHEN {column} IN {top_sql(source, column, k)} THEN {column} ELSE 'Other' END"


def melted(df, keys):
    """Wide features as (key, feature, value) rows, so that level names are data."""
    names = [c for c in df.columns if c not in keys]
    return df.unpivot(list(keys), [F.col(f"`{c}`").cast("double").alias(c) for c in names], "feature", "value")


def one_hot_sql(source, key, expression, prefix, drop_first=True):
    """(key, feature, value) rows of one encoded column."""
    levels = f"(SELECT DISTINCT v FROM (SELECT {expression} AS v FROM {source}) WHERE v IS NOT NULL)"
    kept = f"(SELECT v FROM {levels} WHERE v > (SELECT min(v) FROM {levels}))" if drop_first else levels
    return f"""SELECT s.{key}, '{prefix}_' || l.v AS feature,
        CASE WHEN s.v = l.v THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value
        FROM (SELECT {key}, {expression} AS v FROM {source}) s, {kept} l"""


@query(
    "e1_group_rare",
    f"SELECT p_partkey, {grouped_sql(PART_GAPS, 'p_brand', 10)} AS brand_grouped FROM {PART_GAPS}",
)
def _(spark, d):
    return encode.group_rare(part_with_gaps(spark, d), "p_brand", 10, "brand_grouped").select(
        "p_partkey", "brand_grouped"
    )


@query(
    "e2_one_hot_drop_first",
    union_all([one_hot_sql(PART_GAPS, "p_partkey", c, c) for c in ("p_type", "p_brand")]),
)
def _(spark, d):
    parts = part_with_gaps(spark, d).select("p_partkey", "p_type", "p_brand")
    return melted(encode.one_hot(parts, ["p_type", "p_brand"]), ["p_partkey"])


@query(
    "e3_one_hot_beside_source",
    "SELECT o_orderkey, o_orderstatus, o_orderpriority, "
    + ", ".join(f"""CAST(o_orderstatus = '{s}' AS INTEGER) AS "o_orderstatus_{s}" """ for s in "FOP")
    + ", "
    + ", ".join(
        f"""CAST(coalesce(o_orderpriority = '{p}', '{p}' = 'Unknown') AS INTEGER) AS "o_orderpriority_{p}" """
        for p in ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "Unknown"]
    )
    + " FROM (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders)",
)
def _(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    return encode.one_hot(
        orders, ["o_orderstatus", "o_orderpriority"], drop_first=False, keep_source=True, missing="Unknown"
    )


@query(
    "e4_label_codes",
    f"""SELECT p_partkey, b AS p_brand, dense_rank() OVER (ORDER BY b) - 1 AS brand_encoded
        FROM (SELECT p_partkey, coalesce(p_brand, 'Unknown') AS b FROM {PART_GAPS})""",
)
def _(spark, d):
    return encode.label_codes(part_with_gaps(spark, d).select("p_partkey", "p_brand"), "p_brand", "brand_encoded")


@query(
    "e5_ordinal_codes",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '3-MEDIUM' THEN 1 WHEN '2-HIGH' THEN 2
       WHEN '1-URGENT' THEN 3 END AS priority_encoded FROM orders""",
)
def _(spark, d):
    ranks = {"5-LOW": 0, "3-MEDIUM": 1, "2-HIGH": 2, "1-URGENT": 3}
    return encode.ordinal_codes(table(spark, d, "orders"), "o_orderpriority", ranks, "priority_encoded").select(
        "o_orderkey", "priority_encoded"
    )


@query(
    "e6_booleans_to_int",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_returnflag = 'R' AS INTEGER) AS returned,
       CAST(l_discount > 0.05 AS INTEGER) AS discounted FROM lineitem""",
)
def _(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        (F.col("l_returnflag") == "R").alias("returned"),
        (F.col("l_discount") > 0.05).alias("discounted"),
    )
    return encode.booleans_to_int(lines)


_PRICED = """(SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, CASE WHEN p_retailprice < 925 THEN 'Low'
   WHEN p_retailprice < 950 THEN 'Medium' WHEN p_retailprice < 975 THEN 'High' ELSE 'Premium' END AS price_category FROM part)"""

ENCODED_SQL = union_all(
    [
        one_hot_sql(_PRICED, "p_partkey", grouped_sql(_PRICED, "p_brand", 10), "p_brand_grouped"),
        one_hot_sql(_PRICED, "p_partkey", grouped_sql(_PRICED, "p_name", 20), "p_name_grouped"),
        one_hot_sql(_PRICED, "p_partkey", "p_type", "p_type"),
        f"""SELECT p_partkey, 'price_category_encoded', CASE price_category WHEN 'Low' THEN 0.0 WHEN 'Medium' THEN 1.0
            WHEN 'High' THEN 2.0 ELSE 3.0 END::DOUBLE FROM {_PRICED}""",
        f"SELECT p_partkey, 'p_size', p_size::DOUBLE FROM {_PRICED}",
        f"SELECT p_partkey, 'p_retailprice', p_retailprice FROM {_PRICED}",
    ]
)


@query("e7_encoded_table", ENCODED_SQL)
def encoded_parts(spark, d):
    from shelfwise.functions.numeric import band

    priced = table(spark, d, "part").withColumn(
        "price_category", band("p_retailprice", [925, 950, 975], fx.PRICE_LABELS)
    )
    encoded = encode.encoded_table(
        priced,
        rare={"p_brand": 10, "p_name": 20},
        categories=["p_type"],
        ordinal={"price_category": fx.PRICE_RANKS},
        drop=[*fx.TEXT_COLUMNS_TO_DROP, "p_name", "p_brand"],
    )
    return melted(encoded, ["p_partkey"])


_K_VALUES = ", ".join(f"({i}, '{k}', {w}, {h})" for i, (k, (w, h)) in enumerate(fx.K_RESOLUTIONS.items()))
RESOLUTION_CLASS_SQL = f"""SELECT p_partkey, r AS screen_resolution, coalesce(arg_min(k,
   abs(split_part(r, ' x ', 1)::DOUBLE - w) + abs(split_part(r, ' x ', 2)::DOUBLE - h) + i / 100.0), 'Unknown') AS screen_resolution_k
   FROM (SELECT p_partkey, {NORMAL_RESOLUTION} AS r FROM {TEXTS}), (VALUES {_K_VALUES}) AS refs(i, k, w, h)
   GROUP BY p_partkey, r"""


@query("e8_resolution_class", RESOLUTION_CLASS_SQL)
def _(spark, d):
    texts = spec_texts(spark, d).select("p_partkey", ph.normal_resolution("resolution_text").alias("screen_resolution"))
    return encode.resolution_class(texts)


@query(
    "e9_brand_and_os",
    f"""SELECT *, CASE brand WHEN 'Apple' THEN 'iOS' ELSE 'Android' END AS os FROM (
        SELECT p_partkey, name, coalesce(arg_min(brand, CASE WHEN starts_with(lower(name), word) THEN i
          WHEN contains(lower(name), word) THEN 1000 + i END), 'Other') AS brand
        FROM {_PHONE_NAMES}, (VALUES {_RULES}) AS rules(i, word, brand) GROUP BY p_partkey, name)""",
)
def _(spark, d):
    return encode.brand_and_os(phone_names(spark, d))


SCALED = ["l_quantity", "l_extendedprice", "l_discount", "fixed"]


@query(
    "e10_standard_scaled",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    + ", ".join(f"round((l.{c} - m_{c}) / s_{c}, 6) + 0.0::DOUBLE AS {c}" for c in SCALED[:3])
    + ", 0.0::DOUBLE AS fixed FROM lineitem l, (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALED[:3])
    + " FROM lineitem)",
)
def _(spark, d):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, d, "lineitem").withColumn("fixed", F.lit(3.0))
    scaled = encode.standard_scaled(lines.select(*keys, *SCALED), SCALED)
    return scaled.select(*keys, *[F.round(c, 6).alias(c) for c in SCALED])


@query(
    "e2_one_hot_long",
    """SELECT o_orderkey, dense_rank() OVER (ORDER BY CAST(o_custkey AS VARCHAR)) - 1 AS code,
        CAST(o_custkey AS VARCHAR) AS level FROM orders WHERE o_custkey IS NOT NULL""",
)
def _(spark, d):
    return encode.one_hot_long(table(spark, d, "orders"), "o_orderkey", "o_custkey")


#: Squarings that leave only a matrix' leading direction: its 2**20th power.
_SQUARINGS = 20


def _leading_sql(name, matrix):
    """Common table expressions: the unit eigenvector ``name`` (i, v) of a symmetric matrix (i, j, x), largest entry positive."""
    out, last = [], matrix
    for k in range(_SQUARINGS):
        out.append(f"{name}_q{k} AS MATERIALIZED (SELECT a.i, b.j, sum(a.x * b.x) AS x FROM {last} a JOIN {last} b ON a.j = b.i GROUP BY ALL)")
        last = f"{name}_p{k}"
        out.append(f"{last} AS MATERIALIZED (SELECT i, j, x / (SELECT sum(x) FROM {name}_q{k} WHERE i = j) AS x FROM {name}_q{k})")
    out.append(f"""{name}_u AS (SELECT i, x / sqrt(sum(x * x) OVER ()) AS v FROM {last}
        WHERE j = (SELECT i FROM {last} WHERE i = j ORDER BY x DESC LIMIT 1))""")
    out.append(f"{name} AS MATERIALIZED (SELECT i, v * (SELECT sign(arg_max(v, abs(v))) FROM {name}_u) AS v FROM {name}_u)")
    return out


def _components_sql(long, key):
    """Two components of the scaled columns of (key, i, x) rows, by powers of their correlation matrix."""
    parts = [
        f"x AS MATERIALIZED ({long})",
        "m AS (SELECT i, avg(x) AS m, stddev_pop(x) AS s FROM x GROUP BY i)",
        f"z AS MATERIALIZED (SELECT {key}, i, (x - m) / s AS z FROM x JOIN m USING (i))",
        f"c AS MATERIALIZED (SELECT a.i, b.i AS j, avg(a.z * b.z) AS x FROM z a JOIN z b USING ({key}) GROUP BY ALL)",
        *_leading_sql("v1", "c"),
        "l1 AS (SELECT sum(a.v * c.x * b.v) AS l FROM c JOIN v1 a USING (i) JOIN v1 b ON c.j = b.i)",
        "d AS MATERIALIZED (SELECT c.i, c.j, c.x - l * a.v * b.v AS x FROM c JOIN v1 a USING (i) JOIN v1 b ON c.j = b.i, l1)",
        *_leading_sql("v2", "d"),
        f"""pc AS (SELECT {key}, round(sum(z * v1.v), 4) + 0.0::DOUBLE AS pc_1, round(sum(z * v2.v), 4) + 0.0::DOUBLE AS pc_2
            FROM z JOIN v1 USING (i) JOIN v2 USING (i) GROUP BY ALL)""",
    ]
    return "WITH " + ", ".join(parts)


_LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_LINE_NUMBERS = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
_LINE_EDGES = ", ".join(f"quantile_cont(l_extendedprice, {i}.0::DOUBLE / {len(fx.PRICE_LABELS)}) AS e{i}" for i in range(1, len(fx.PRICE_LABELS)))
_LINE_BAND = " ".join(f"WHEN l_extendedprice <= e{i + 1} THEN '{label}'" for i, label in enumerate(fx.PRICE_LABELS[:-1]))
_LINE_LONG = " UNION ALL ".join(
    f"SELECT r, {i} AS i, CAST({c} AS DOUBLE) AS x FROM line" for i, c in enumerate(_LINE_NUMBERS)
)


def _rounded(df, keep):
    return df.select(*keep, *[(F.round(c, 4) + F.lit(0.0)).alias(c) for c in ("pc_1", "pc_2")])


@query(
    "e11_two_components",
    _components_sql(_LINE_LONG, "r").replace("WITH ", "WITH line AS MATERIALIZED (SELECT *, row_number() OVER () AS r FROM lineitem), ", 1)
    + f"""SELECT {", ".join(_LINE_KEYS)}, CASE WHEN l_extendedprice IS NULL THEN NULL {_LINE_BAND} ELSE '{fx.PRICE_LABELS[-1]}' END AS price_category,
        pc_1, pc_2 FROM line JOIN pc USING (r), (SELECT {_LINE_EDGES} FROM lineitem)""",
)
def _(spark, d):
    lines = table(spark, d, "lineitem")
    priced = impute.quantile_bands(
        lines.withColumn("price", F.col("l_extendedprice")), "price", fx.PRICE_LABELS, "price_category"
    )
    keep = [*_LINE_KEYS, "price_category"]
    return _rounded(encode.two_components(priced, _LINE_NUMBERS, keep), keep)


@query(
    "e11_embedding_components",
    _components_sql(
        "SELECT vec_id, k AS i, CAST(embedding[k] AS DOUBLE) AS x FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS k FROM embeddings)", "vec_id"
    )
    + "SELECT vec_id, label, pc_1, pc_2 FROM embeddings JOIN pc USING (vec_id)",
)
def _(spark, d):
    vectors = table(spark, d, "embeddings")
    names = [f"x{i}" for i in range(64)]
    wide = vectors.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    return _rounded(encode.two_components(wide, names, ["vec_id", "label"]), ["vec_id", "label"])
