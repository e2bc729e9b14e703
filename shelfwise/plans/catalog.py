"""The phone catalog from nested records to a model-ready table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise import fixed_values as fx
from shelfwise.functions import phone as ph
from shelfwise.functions import text as tx
from shelfwise.functions.numeric import band, to_number
from shelfwise.functions.specs import merged_specs
from shelfwise.operators import encode, impute, lookup, rows
from shelfwise.operators.aggregate import rare_values
from shelfwise.session import hand_off

NUMBERS = ["ram", "internal_memory", "refresh_rate", "camera_count", "battery_capacity"]
TEXTS = ["chipset", "cpu", "screen_size", "screen_resolution", "screen_tech", "camera_main_resolution", "security"]
SMALLEST_BRAND = 8


def extract_features(products: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One feature row per nested product; failed records keep their address only."""
    merged = products.withColumn("_specs", merged_specs("specifications"))
    return merged.select(*keep, *ph.features("_specs"))


def clean_and_impute(features: DataFrame, order: Sequence[str]) -> DataFrame:
    """Duplicates and non-phones out, every feature filled.

    ``order`` names the columns that tell which of two duplicates came first.
    """
    first = rows.keep_first(features, ["name", "price"], order)
    branded = hand_off(encode.brand_and_os(first), "branded")

    by_price = impute.quantile_bands(
        impute.fill_median(branded.withColumn("_price", F.col("price")), "_price"),
        "_price",
        fx.SEGMENT_LABELS,
        "_segment",
        merge_equal=True,
    )
    filled = impute.fill_group_medians(by_price, "_segment", ["ram"], min_values=3).drop("_price", "_segment")

    phones = rows.without_keywords(rows.drop_missing(filled, ["price", "name"]), "name", fx.NON_PHONE_WORDS)
    phones = impute.fill_constant(phones, {"refresh_rate": fx.DEFAULT_REFRESH_RATE})
    for target, known in (
        ("chipset", fx.CHIPSET_BY_NAME),
        ("cpu", fx.CHIPSET_BY_NAME),
        ("camera_main_resolution", fx.CAMERA_BY_NAME),
        ("screen_resolution", fx.RESOLUTION_BY_NAME),
        ("screen_tech", fx.SCREEN_TECH_BY_NAME),
        ("battery_capacity", fx.BATTERY_BY_NAME),
    ):
        phones = lookup.backfill(phones, "name", target, known)
    for target, label in (("chipset", " Unknown Chip"), ("cpu", " Unknown CPU")):
        phones = impute.fill_from_column(phones, target, F.concat("brand", F.lit(label)))

    phones = hand_off(phones, "phones")
    phones = impute.fill_group_medians(phones, "brand", NUMBERS)
    return impute.fill_group_modes(phones, "brand", TEXTS)


def normalise(cleaned: DataFrame, order: Sequence[str]) -> DataFrame:
    """Names, chipsets, cameras and resolutions normalised; derived features added."""
    tidy = cleaned.withColumns(
        {
            "name": tx.clean_name(F.coalesce("name", F.lit(""))),
            "chipset": tx.clean_chipset(F.coalesce("chipset", F.lit(""))),
            "camera_main_resolution": ph.camera_mp("camera_main_resolution"),
            "screen_resolution": ph.normal_resolution("screen_resolution"),
        }
    )
    first = hand_off(rows.keep_first(tidy, ["name", "price"], order), "tidy")
    common = lookup.drop_members(first, "brand", rare_values(first, "brand", SMALLEST_BRAND))
    common = common.withColumn("price_category", band("price", fx.PRICE_EDGES, fx.PRICE_LABELS))
    common = encode.resolution_class(encode.brand_and_os(common))
    return common.withColumn("chip_model", ph.chip_model("chipset"))


def encode_for_model(features: DataFrame, drop: Sequence[str] = fx.TEXT_COLUMNS_TO_DROP) -> DataFrame:
    """0/1 and numeric columns only; a screen size that is no number is missing."""
    return encode.encoded_table(
        features.withColumn("screen_size", to_number("screen_size")),
        rare={"screen_tech": 20, "brand": 10, "chip_model": 10},
        categories=["screen_resolution_k", "os", "security"],
        ordinal={"price_category": fx.PRICE_RANKS},
        drop=drop,
    )
