"""Headphone kind, flags and connector from names and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise import fixed_values as fx
from shelfwise.functions import text as tx
from shelfwise.functions.text import col, flag

# Words in product names, per shop rule.
OVER_EAR = "chụp tai|chup tai|over-ear"
NAME_RULES = {
    "first": {"gaming": "gaming|game", "in_ear": "nhét tai|nhet tai|earbuds"},
    "other": {"gaming": "gaming", "in_ear": "in-ear|nhét tai|nhet tai"},
}
WIRELESS_WORDS = "bluetooth|wireless"
MIC_WORDS = "mic"
FIRST_WORD = r"\b([a-zA-Z]{3,})\b"
WIRELESS_CONNECTION = "wireless|bluetooth"
TRUE_WIRELESS_TYPE = "true wireless|tws"
GAMING_TYPE = "gaming"


def name_traits(name: Column | str, rule: str = "first") -> dict[str, Column]:
    """type, is_gaming, is_wireless and has_mic as a name tells them."""
    words = NAME_RULES[rule]
    over, inside = flag(name, OVER_EAR) == 1, flag(name, words["in_ear"]) == 1
    return {
        "type": F.when(over, "over-ear").when(inside, "in-ear").otherwise(""),
        "is_gaming": flag(name, words["gaming"]),
        "is_wireless": flag(name, WIRELESS_WORDS),
        "has_mic": flag(name, MIC_WORDS),
    }


def brand_guess(name: Column | str) -> Column:
    """The first plain word of three or more letters: a weak guess, '' without one."""
    return F.coalesce(tx.extract(name, FIRST_WORD), F.lit(""))


def connector(c: Column | str) -> Column:
    """One of the known connector names, or NULL for blank, long or unknown text."""
    short = tx.strip(c)
    low = F.lower(short)
    return (
        F.when((short == "") | (F.length(short) > fx.CONNECTOR_LONGEST), None)
        .when(low.contains("3.5"), "3.5mm")
        .when(low.rlike("type c|usb-c|usb c"), "Type C")
        .when(low.startswith("usb"), "USB-A")
        .when(low.rlike("bluetooth|wireless"), "Bluetooth")
        .when(short.isin(fx.CONNECTORS), short)
    )


def connection_traits(connection: str, kind: str) -> dict[str, Column]:
    return {
        "is_wireless": flag(connection, WIRELESS_CONNECTION),
        "is_tws": flag(kind, TRUE_WIRELESS_TYPE),
        "is_gaming": flag(kind, GAMING_TYPE),
    }
