"""Sources and sinks (S). Every file read here was written by Spark from a given table."""

from pyspark.sql import functions as F

from shelfwise.queries import query
from shelfwise.session import scratch_path
from shelfwise.sources import readers, writers
from shelfwise.sources.derived import PHONE_NAME, nested_catalog
from shelfwise.sources.tables import part_with_gaps, table

PART_DDL = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


@query("s1_csv_scan", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def _(spark, d):
    path = scratch_path(spark, "csv")
    writers.write_csv(table(spark, d, "part"), path)
    return readers.read_csv(spark, path, PART_DDL)


@query(
    "s1_mixed_headers",
    "SELECT p_partkey, p_name, CASE WHEN p_size % 2 = 0 THEN p_brand END AS p_brand, p_size FROM part",
)
def _(spark, d):
    """Files with two headers in one folder, the second one in another order and without the brand."""
    path = scratch_path(spark, "mixed")
    parts = table(spark, d, "part")
    writers.write_csv(parts.where("p_size % 2 = 0").select("p_partkey", "p_name", "p_brand", "p_size"), f"{path}/even")
    writers.write_csv(parts.where("p_size % 2 = 1").select("p_size", "p_name", "p_partkey"), f"{path}/odd")
    return readers.read_csv(spark, f"{path}/*", "p_partkey bigint, p_name string, p_brand string, p_size int", mixed=True)


def product_lines(spark, d):
    """Nested products written as lines that each hold an array of at most 50 records."""
    path = scratch_path(spark, "json")
    chunk = (F.regexp_extract("url", r"p(\d+)\.html", 1).cast("long") / 50).cast("long")
    lines = (
        nested_catalog(spark, d)
        .groupBy(chunk.alias("chunk"))
        .agg(F.to_json(F.collect_list(F.struct("*"))).alias("value"))
    )
    lines.select("value").write.text(path)
    return path


@query(
    "s2_nested_json_scan",
    f"""SELECT 'https://shop.example/p' || p_partkey || '.html' AS url, CASE WHEN p_partkey % 17 <> 0 THEN {PHONE_NAME} END AS name,
       CASE WHEN p_partkey % 17 = 0 THEN 'timeout' END AS error,
       CAST(CASE WHEN p_partkey % 17 <> 0 THEN 4 END AS INTEGER) AS n_specs FROM part""",
)
def _(spark, d):
    return readers.read_products(spark, product_lines(spark, d)).select("url", "name", "error", F.size("specifications").alias("n_specs"))


@query("s3_link_list_scan", 'SELECT url AS "Product Link" FROM pages')
def _(spark, d):
    path = scratch_path(spark, "links")
    writers.write_links(table(spark, d, "pages"), "url", path)
    return readers.read_links(spark, path)


def _raw_folder(spark, d):
    """Three shops' dated files; each shop's older file is a different slice of ``part``."""
    folder = scratch_path(spark, "raw")
    parts = table(spark, d, "part")
    for shop in range(3):
        mine = parts.where(F.col("p_size") % 3 == shop)
        writers.write_csv(mine.where("p_type = 'PROMO'"), f"{folder}/shop_{shop}_20240101_080000")
        writers.write_csv(mine.where("p_type <> 'PROMO'"), f"{folder}/shop_{shop}_20240301_080000")
    return folder


PREFIXES = ["shop_0", "shop_1", "shop_2", "shop_9"]


@query(
    "s4_latest_file",
    """SELECT 'shop_' || (p_size % 3) AS prefix, 'shop_' || (p_size % 3) || '_20240301_080000' AS entry,
       count(*) AS n FROM part WHERE p_type <> 'PROMO' GROUP BY p_size % 3""",
)
def _(spark, d):
    found = readers.latest_paths(spark, _raw_folder(spark, d), PREFIXES)
    frames = [
        readers.read_csv(spark, path, PART_DDL)
        .agg(F.count("*").alias("n"))
        .select(F.lit(prefix).alias("prefix"), F.lit(path.split("/")[-1]).alias("entry"), "n")
        for prefix, path in found.items()
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@query(
    "s5_multi_source_load",
    """SELECT p_partkey, p_name, p_size, CAST(p_size % 3 AS INTEGER) AS source_rank
       FROM part WHERE p_type <> 'PROMO'""",
)
def _(spark, d):
    return readers.read_latest(spark, _raw_folder(spark, d), PREFIXES, PART_DDL).select(
        "p_partkey", "p_name", "p_size", "source_rank"
    )


@query("s7_csv_sink", """SELECT p_partkey, p_name || ', "' || p_type || '"' AS label FROM part""")
def _(spark, d):
    path = scratch_path(spark, "csv")
    label = F.concat("p_name", F.lit(', "'), "p_type", F.lit('"'))
    writers.write_csv(table(spark, d, "part").select("p_partkey", label.alias("label")), path)
    return readers.read_csv(spark, path, "p_partkey bigint, label string")


@query("s8_json_sink", "SELECT doc_id, text, lang, n_chars FROM documents")
def _(spark, d):
    path = scratch_path(spark, "json")
    writers.write_json(table(spark, d, "documents"), path)
    return spark.read.schema("doc_id bigint, text string, lang string, n_chars bigint").json(path)


@query(
    "s9_fixed_column_sink",
    """SELECT 'part' AS source, CAST(NULL AS VARCHAR) AS url, p_name AS name,
       CASE WHEN p_partkey % 11 <> 0 THEN p_brand END AS brand, CAST(NULL AS VARCHAR) AS connection FROM part""",
)
def _(spark, d):
    path = scratch_path(spark, "fixed")
    parts = part_with_gaps(spark, d).select(
        F.lit("part").alias("source"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), "p_size"
    )
    writers.write_fixed(parts, path)
    return readers.read_csv(spark, path, readers.HEADPHONE_SCHEMA).select(
        "source", "url", "name", "brand", "connection"
    )


@query("s10_link_list_sink", 'SELECT DISTINCT url AS "Product Link" FROM pages')
def _(spark, d):
    path = scratch_path(spark, "links")
    writers.write_links(table(spark, d, "pages").select("url").distinct(), "url", path)
    return readers.read_links(spark, path)


