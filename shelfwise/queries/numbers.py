"""Numbers, dates, arrays, maps and JSON (N, DT, M)."""

from pyspark.sql import functions as F

from shelfwise import fixed_values as fx
from shelfwise.functions import numeric as nm
from shelfwise.functions import specs as sp
from shelfwise.functions import text as tx
from shelfwise.queries import query
from shelfwise.queries.sql import strip
from shelfwise.sources.derived import nested_catalog, spec_texts, spec_texts_sql
from shelfwise.sources.tables import spread, table, width

TEXTS = spec_texts_sql()


@query(
    "n1_to_number",
    f"""SELECT p_partkey, CASE WHEN regexp_matches(size_text, '^[0-9.]+$') THEN TRY_CAST(size_text AS DOUBLE) END AS size_number,
        TRY_CAST(hz_text AS DOUBLE) AS hz_number FROM {TEXTS}""",
)
def _(spark, d):
    return spec_texts(spark, d).select(
        "p_partkey", nm.to_number("size_text").alias("size_number"), nm.to_number("hz_text").alias("hz_number")
    )


LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_SQL = ", ".join(LINE)


@query("n2_truncate", f"SELECT {LINE_SQL}, CAST(trunc(l_extendedprice) AS BIGINT) AS result FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select(*LINE, nm.truncate("l_extendedprice").alias("result"))


@query(
    "n4_safe_ratio",
    f"SELECT {LINE_SQL}, round(l_extendedprice / 1e6 / nullif(l_discount, 0), 9) AS result FROM lineitem",
)
def _(spark, d):
    ratio = nm.ratio_in_millions("l_extendedprice", "l_discount")
    return table(spark, d, "lineitem").select(*LINE, F.round(ratio, 9).alias("result"))


@query(
    "n5_price_band",
    """SELECT o_orderkey, CASE WHEN v < 3000000 THEN 'Low' WHEN v < 8000000 THEN 'Medium'
       WHEN v < 15000000 THEN 'High' WHEN v IS NOT NULL THEN 'Premium' END AS result
       FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice * 40 END AS v FROM orders)""",
)
def _(spark, d):
    value = F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice") * 40)
    return table(spark, d, "orders").select(
        "o_orderkey", nm.band(value, fx.PRICE_EDGES, fx.PRICE_LABELS).alias("result")
    )


@query(
    "n6_round_two_places",
    f"SELECT {LINE_SQL}, round_even(l_extendedprice * l_discount * 100, 0) / 100 AS result FROM lineitem",
)
def _(spark, d):
    value = F.col("l_extendedprice") * F.col("l_discount")
    return table(spark, d, "lineitem").select(*LINE, nm.round_half_even(value, 2).alias("result"))


@query(
    "n7_unit_scaling",
    f"SELECT {LINE_SQL}, round(l_extendedprice / 1e6, 9) AS millions, l_quantity * 1024 AS megabytes FROM lineitem",
)
def _(spark, d):
    return table(spark, d, "lineitem").select(
        *LINE,
        F.round(nm.scaled("l_extendedprice", 1e-6), 9).alias("millions"),
        nm.scaled("l_quantity", 1024).alias("megabytes"),
    )


GRAMS = r"TRY_CAST(nullif(regexp_extract(replace(weight_text, ',', '.'), '([\d.,]+)\s*g', 1, 'i'), '') AS DOUBLE)"


@query("n8_grams", f"SELECT p_partkey, {GRAMS} AS result FROM {TEXTS}")
def _(spark, d):
    return spec_texts(spark, d).select("p_partkey", nm.grams("weight_text").alias("result"))


@query(
    "n9_largest_integer",
    r"""SELECT doc_id, list_max(list_transform(regexp_extract_all(text, '\d+'), lambda x: TRY_CAST(x AS BIGINT))) AS result
        FROM documents""",
)
def _(spark, d):
    return spread(table(spark, d, "documents"), width(spark)).select("doc_id", nm.largest_integer("text").alias("result"))


@query(
    "dt1_parse_timestamp",
    """SELECT event_id, strftime(ts, '%d/%m/%Y %H-%M-%S') AS parsed,
       CASE WHEN event_id % 3 <> 0 THEN strftime(ts, '%d/%m/%Y %H-%M-%S') END AS lenient FROM events""",
)
def _(spark, d):
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    broken = F.when(F.col("event_id") % 3 != 0, stamp).otherwise(F.lit("no time"))
    return table(spark, d, "events").select(
        "event_id",
        F.date_format(nm.parse_timestamp(stamp), "dd/MM/yyyy HH-mm-ss").alias("parsed"),
        F.date_format(nm.parse_timestamp(broken, lenient=True), "dd/MM/yyyy HH-mm-ss").alias("lenient"),
    )


@query("dt2_hour_month", "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(month(ts) AS INTEGER) AS month FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_id", F.hour("ts").alias("hour"), F.month("ts").alias("month"))


@query(
    "dt3_weekday",
    "SELECT event_id, CAST(isodow(ts) - 1 AS INTEGER) AS weekday, strftime(ts, '%a') AS name FROM events",
)
def _(spark, d):
    return table(spark, d, "events").select(
        "event_id", F.weekday("ts").alias("weekday"), nm.weekday_name("ts").alias("name")
    )


@query("dt4_calendar_date", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_id", F.to_date("ts").cast("string").alias("day"))


@query(
    "m1_merged_specs",
    f"""SELECT url, key, value FROM (SELECT 'https://shop.example/p' || p_partkey || '.html' AS url, unnest([
          {{'key': 'chipset', 'value': chipset_text}}, {{'key': 'ram', 'value': coalesce(ram_text, size_text)}},
          {{'key': 'bộ nhớ trong', 'value': rom_text}}, {{'key': 'kích thước màn hình', 'value': size_text}},
          {{'key': 'độ phân giải', 'value': resolution_text}}, {{'key': 'công nghệ màn hình', 'value': tech_text}},
          {{'key': 'tần số quét', 'value': hz_text}}, {{'key': 'chuẩn màn hình', 'value': standard_text}},
          {{'key': 'camera sau', 'value': camera_text}}, {{'key': 'pin', 'value': battery_text}},
          {{'key': 'bảo mật', 'value': security_text}}], recursive := true) FROM {TEXTS} WHERE p_partkey % 17 <> 0)
        WHERE value IS NOT NULL""",
)
def _(spark, d):
    return nested_catalog(spark, d).select("url", F.explode(sp.merged_specs("specifications")))


@query(
    "m2_list_as_text",
    """SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN role || ' | ' || turn ELSE role END AS result FROM conversations""",
)
def _(spark, d):
    listed = F.to_json(F.array("role", F.col("turn").cast("string")))
    value = F.when(F.col("turn") % 2 == 0, listed).otherwise(F.col("role"))
    return table(spark, d, "conversations").select("conv_id", "turn", sp.list_as_text(value).alias("result"))


@query(
    "m3_label_lookup",
    """SELECT event_id, coalesce(nullif(json_extract_string(props, '$.missing'), ''), nullif(json_extract_string(props, '$.k'), '')) AS result
       FROM events""",
)
def _(spark, d):
    props = F.from_json("props", "map<string,string>")
    return table(spark, d, "events").select("event_id", sp.lookup(props, ["missing", "k"]).alias("result"))


@query(
    "m4_multi_line_cell",
    f"""SELECT doc_id, CASE WHEN contains({strip('text')}, chr(10)) THEN array_to_string(list_filter(list_transform(
          string_split(text, chr(10)), lambda x: {strip('x')}), lambda x: x <> ''), ' | ') ELSE {strip('text')} END AS result
        FROM documents""",
)
def _(spark, d):
    return spread(table(spark, d, "documents"), width(spark)).select("doc_id", tx.cell_value("text").alias("result"))


@query(
    "m7_failed_records",
    """SELECT 'https://shop.example/p' || p_partkey || '.html' AS url, CAST(p_partkey % 17 = 0 AS INTEGER) AS failed,
       CAST(CASE WHEN p_partkey % 17 = 0 THEN 0 ELSE 4 END AS INTEGER) AS n_specs FROM part""",
)
def _(spark, d):
    return nested_catalog(spark, d).select(
        "url",
        F.col("error").isNotNull().cast("int").alias("failed"),
        F.size(sp.usable_specs("specifications")).alias("n_specs"),
    )
