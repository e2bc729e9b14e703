"""The headphone catalog from dated raw files to a model-ready table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import fixed_values as fx
from shelfwise.functions import headphone as hp
from shelfwise.functions.numeric import ratio_in_millions, to_number
from shelfwise.operators import encode, rows
from shelfwise.session import hand_off
from shelfwise.sources.readers import HEADPHONE_OPTIONAL, HEADPHONE_SCHEMA, ORIGIN, read_latest

ORDER = ["source_rank", *ORIGIN]
FLAGS = ["is_gaming", "is_wireless", "has_mic", "has_anc", "water_resistant"]
MEASURES = ["driver_size_mm", "impedance_ohm", "sensitivity_db", "warranty_months", "rating", "num_reviews"]


def merge_raw(spark: SparkSession, folder: str, prefixes: Sequence[str]) -> DataFrame:
    """Newest file per shop, one row per address; the earlier shop wins."""
    return rows.keep_first(read_latest(spark, folder, prefixes, f"{HEADPHONE_SCHEMA}, {HEADPHONE_OPTIONAL}"), ["url"], ORDER)


def clean(raw: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    usable = rows.usable_products(raw, "price_vnd", ["brand", "type"])
    first = rows.keep_first(usable, ["url"], order)
    return first.withColumns(
        {
            "price_vnd": to_number("price_vnd").try_cast("long"),
            **{c: F.coalesce(to_number(c).try_cast("int"), F.lit(0)) for c in FLAGS if c in first.columns},
            "connection": hp.connector("connection"),
            "battery_life_hours": to_number("battery_life_hours"),
            "weight_gram": to_number("weight_gram"),
            **{c: to_number(c) for c in MEASURES if c in first.columns},
        }
    ).drop(*order)


def add_features(cleaned: DataFrame) -> DataFrame:
    """Plausible prices only; traits from connection and type, price per battery hour."""
    priced = rows.within(rows.positive(cleaned, "price_vnd"), "price_vnd", *fx.HEADPHONE_PRICE_RANGE)
    traits = hp.connection_traits("connection", "type")
    optional = {"price_per_driver_mm": ratio_in_millions("price_vnd", "driver_size_mm")} if "driver_size_mm" in cleaned.columns else {}
    return priced.withColumns(
        {
            **optional,
            "is_wireless": traits["is_wireless"],
            "is_tws": traits["is_tws"],
            "is_gaming": F.greatest("is_gaming", traits["is_gaming"]),
            "price_per_battery_hour": ratio_in_millions("price_vnd", "battery_life_hours"),
        }
    )


def encode_for_model(features: DataFrame, brands: int = 15) -> DataFrame:
    return encode.encoded_table(features, rare={"brand": brands}, categories=["type"], drop=[])


def headphone_table(spark: SparkSession, folder: str, prefixes: Sequence[str]) -> DataFrame:
    """Merge, clean, add features and encode."""
    features = add_features(clean(merge_raw(spark, folder, prefixes)))
    return encode_for_model(hand_off(features, "headphones"))
