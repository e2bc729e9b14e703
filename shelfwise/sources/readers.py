"""Scans: CSV, nested JSON, link lists and dated raw folders. Schemas are always explicit."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.rows import ranked_union

log = logging.getLogger(__name__)

LINK_COLUMN = "Product Link"
ORIGIN = {"origin_file": "string", "origin_offset": "bigint", "origin_row": "bigint"}

PRODUCT_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField(
            "specifications",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("category", T.StringType()),
                        T.StructField("details", T.MapType(T.StringType(), T.StringType())),
                    ]
                )
            ),
        ),
    ]
)

HEADPHONE_SCHEMA = (
    "source string, url string, name string, price_raw string, price_vnd bigint, brand string, "
    "type string, is_gaming int, is_wireless int, has_mic int, connection string, "
    "battery_life_hours string, weight_gram string"
)
#: Columns that a headphone file may have besides.
HEADPHONE_OPTIONAL = (
    "driver_size_mm string, impedance_ohm string, sensitivity_db string, has_anc int, water_resistant int, "
    "warranty_months string, rating string, num_reviews string"
)

CALL_SCHEMA = (
    "lat string, lng string, `desc` string, zip string, title string, timeStamp string, "
    "twp string, addr string, e string"
)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    multi_line: bool = False,
    required: Sequence[str] = (),
    extra: bool = False,
    corrupt: str | None = None,
    mixed: bool = False,
) -> DataFrame:
    """CSV with header, its columns matched by name. Paths of a list may differ in their columns.

    Columns that a file lacks are NULL, or an error if ``required``; columns beyond the schema
    come as text with ``extra`` and are left out otherwise. Within one path all files must have one
    header; another one is an error, unless ``mixed`` says that they may differ: files are then
    grouped by their first line, in one pass over the lines, and each group is a scan of its own.
    ``corrupt`` names a column for lines that cannot be read as typed. ``multi_line`` allows line
    breaks in cells, at the price of unsplittable files.
    """
    wanted = spark.createDataFrame([], schema).schema
    options = dict(header=True, multiLine=multi_line, escape='"', encoding="UTF-8")
    frames = []
    paths = [path] if isinstance(path, str) else list(path)
    for one in [g for p in paths for g in files_by_header(spark, p) or [p]] if mixed else paths:
        found = spark.read.csv(one, **options).columns
        missing = [c for c in required if c not in found]
        if missing:
            raise ValueError(f"{one} lacks the columns {', '.join(missing)}")
        types = {f.name: f.dataType for f in wanted.fields}
        own = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in found])
        if corrupt:
            own = own.add(corrupt, T.StringType())
        read = spark.read.schema(own).csv(
            one, mode="PERMISSIVE", enforceSchema=False, columnNameOfCorruptRecord=corrupt, **options
        )
        # The scan's hidden file columns stay reachable: only names and order change.
        kept = [F.col(f"`{f.name}`") if f.name in found else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted.fields]
        kept += [F.col(f"`{c}`") for c in found if extra and c not in types]
        frames.append(read.select(*kept, *([corrupt] if corrupt else [])))
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def files_by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """The files of a path in groups of one first line; empty files have none and are left out.

    Each file gives the driver its name, which the scans list anyway; first lines are compared in Spark.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "line").alias("header"))
    # Names come as URIs; readers take plain paths, in which pattern characters are escaped.
    plain = F.regexp_replace(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))), r"([\[\]{}*?\\])", r"\\$1")
    groups = first.groupBy("header").agg(F.array_sort(F.collect_list(plain)).alias("files")).orderBy("files").collect()
    return [g["files"] for g in groups]


def with_origin(df: DataFrame) -> DataFrame:
    """Adds the position of each row in its source: file, split offset and row in the split.

    This is the row order that keep-first steps go by; call it directly on a scan.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("origin_file"),
        F.col("_metadata.file_block_start").alias("origin_offset"),
        F.monotonically_increasing_id().alias("origin_row"),
    )


def read_products(spark: SparkSession, path: str | Sequence[str], array_file: bool = False) -> DataFrame:
    """Nested products. Lines may hold one record or an array of records.

    ``array_file`` reads files that are one pretty-printed array each; such a file cannot
    be split, so large inputs should come as lines.
    """
    return spark.read.schema(PRODUCT_SCHEMA).json(path, multiLine=array_file)


def read_links(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return read_csv(spark, path, f"`{LINK_COLUMN}` string")


def belongs(entry: str, prefix: str) -> Column:
    """Is the entry the prefix itself, or the prefix and then no further letter or digit?"""
    name = F.col(entry)
    after = F.substr(name, F.lit(len(prefix) + 1), F.lit(1))
    return name.startswith(prefix) & (F.lit(not prefix[-1:].isalnum()) | ~after.rlike(r"^[\p{L}\p{N}]"))


def latest_paths(spark: SparkSession, folder: str, prefixes: Sequence[str], suffix: str = ".csv") -> dict[str, str]:
    """Newest entry per prefix of a raw folder, by name (names carry a timestamp).

    An entry is a file, or a folder of part files. Only names are read; one row per
    prefix reaches the driver.
    """
    root = folder.rstrip("/")
    mark = F.lit(root.split(":")[-1] + "/")
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
        .load(root)
        .select(F.split_part(F.substr("path", F.instr("path", mark) + F.length(mark)), F.lit("/"), F.lit(1)).alias("entry"))
    )
    newest = listed.agg(
        *[F.max(F.when(belongs("entry", p), F.col("entry"))).alias(f"p{i}") for i, p in enumerate(prefixes)],
        F.count("*").alias("files"),
    ).first()
    if newest["files"] and not any(newest[i] for i in range(len(prefixes))):
        raise ValueError(f"{folder} has {newest['files']} {suffix} files, but none of {', '.join(prefixes)}")
    return {p: f"{root}/{newest[i]}" for i, p in enumerate(prefixes) if newest[i] is not None}


def read_latest(
    spark: SparkSession, folder: str, prefixes: Sequence[str], schema: T.StructType | str
) -> DataFrame:
    """Union of the newest entry per prefix with source rank and origin; missing sources are skipped."""
    found = latest_paths(spark, folder, prefixes)
    for p in prefixes:
        if p not in found:
            log.warning("no raw file for prefix %s", p)
    frames = [with_origin(read_csv(spark, found[p], schema)) for p in prefixes if p in found]
    if not frames:
        empty = spark.createDataFrame([], schema)
        return ranked_union([empty.selectExpr("*", *[f"cast(null as {t}) as {c}" for c, t in ORIGIN.items()])])
    return ranked_union(frames)
