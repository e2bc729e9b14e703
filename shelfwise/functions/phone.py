"""Phone features from specification text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise import fixed_values as fx
from shelfwise.functions import text as tx
from shelfwise.functions.numeric import to_number
from shelfwise.functions.specs import lookup
from shelfwise.functions.text import col, extract

# Patterns of the specification texts.
NUMBER = r"(\d+(?:\.\d+)?)"
GIGABYTES = NUMBER + r"\s*(?:gb|g\b)"
TERABYTES = NUMBER + r"\s*(?:tb|t\b)"
INCHES = r"([\d\.|\,]+)\s*inches?"
LEADING_DECIMAL = r"([\d\.]+)"
TWO_SIDES = r"(\d+)\s*[xX×]\s*(\d+)"
K_TEXT = r"([\d\.]+\s*K)"
HD_FAMILY = r"(Full HD|FHD|HD\+|HD|UHD|2K|QHD|WQHD)"
MAIN_SCREEN = r"màn\s+chính\s*:\s*(.*?)(?:,|\.|$|;)"
HERTZ = r"(\d+)\s*hz"
MEGAPIXELS = r"(?i)(\d+(?:\.\d+)?)\s*mp"
MILLIAMPERE_HOURS = r"([\d\.,]+)\s*mAh"
K_VALUE = r"(\d+(?:\.\d+)?)\s*k"


def cpu(chipset: Column | str) -> Column:
    return F.get(F.split(tx.some(chipset), r" \| "), F.lit(0))


def ram_gb(c: Column | str) -> Column:
    return F.coalesce(extract(c, GIGABYTES), extract(c, NUMBER)).try_cast("double")


def storage_gb(c: Column | str) -> Column:
    return F.coalesce(extract(c, TERABYTES).try_cast("double") * 1024, ram_gb(c))


def screen_inches(c: Column | str) -> Column:
    """Kept as text; a decimal comma turns into NULL only when coerced to a number."""
    return F.coalesce(extract(c, INCHES, ignore_case=False), extract(c, LEADING_DECIMAL))


def resolution_text(c: Column | str) -> Column:
    sides = F.when(
        col(c).rlike(TWO_SIDES),
        F.concat_ws(" x ", extract(c, TWO_SIDES, 1), extract(c, TWO_SIDES, 2)),
    )
    return F.coalesce(sides, extract(c, K_TEXT), extract(c, HD_FAMILY), tx.some(c))


def screen_tech(c: Column | str) -> Column:
    """The main screen's part where several screens are listed, else the text."""
    main = F.when(tx.matches(c, MAIN_SCREEN), tx.strip(F.regexp_extract(col(c), tx.UNICODE_NOCASE + MAIN_SCREEN, 1)))
    return F.coalesce(main, tx.some(c))


def refresh_hz(own: Column | str, second: Column | str) -> Column:
    """Hertz from the rate label (with or without unit), else from the screen standard."""
    stated = F.coalesce(extract(own, HERTZ).try_cast("int"), to_number(own).try_cast("int"))
    return F.when(tx.some(own).isNotNull(), stated).otherwise(extract(second, HERTZ).try_cast("int"))


def megapixels(c: Column | str) -> Column:
    found = F.regexp_extract_all(col(c), F.lit(MEGAPIXELS), F.lit(1))
    return F.transform(found, lambda x: x.try_cast("double"))


def camera_resolution(c: Column | str) -> Column:
    return F.concat(F.array_max(megapixels(tx.some(c))).cast("string"), F.lit(" MP"))


def camera_count(c: Column | str) -> Column:
    """Number of resolutions listed: 0 for text without any, NULL for no text."""
    return F.size(megapixels(tx.some(c)))


def battery_mah(c: Column | str) -> Column:
    run = extract(tx.squeeze(c), MILLIAMPERE_HOURS)
    return tx.some(F.regexp_replace(run, "[^0-9]", "")).try_cast("int")


def _tags(values: Column, tag_list) -> Column:
    """Distinct, sorted tags over all values."""
    lowered = F.transform(F.filter(values, lambda v: v != ""), F.lower)
    tags = F.flatten(F.transform(lowered, lambda v: F.array_compact(F.array(*tag_list(v)))))
    return F.array_sort(F.array_distinct(tags))


def wireless_tags(specs: Column | str, name: Column | str) -> Column:
    """Networks, Wi-Fi and Bluetooth with version, NFC and GPS named anywhere in the specs."""

    def versioned(v, words, patterns, label):
        version = tx.first_match(v, patterns)
        named = v.contains(words[0])
        for w in words[1:]:
            named = named | v.contains(w)
        return F.when(named, F.concat_ws(" ", F.lit(label), version))

    def tags(v):
        return [
            F.when(v.contains("5g"), "5G"),
            F.when(v.contains("4g") | v.contains("lte"), "4G"),
            F.when(v.contains("3g"), "3G"),
            versioned(v, ["wifi", "wi-fi"], [r"wifi\s*([\d\.]+)", r"wi-fi\s*([\d\.]+)"], "WiFi"),
            versioned(v, ["bluetooth"], [r"bluetooth\s*([\d\.]+)"], "Bluetooth"),
            F.when(v.contains("nfc"), "NFC"),
            F.when(v.contains("gps"), "GPS"),
        ]

    title = F.lower(F.coalesce(col(name), F.lit("")))
    from_name = F.array_compact(F.array(F.when(title.contains("5g"), "5G"), F.when(title.contains("4g"), "4G")))
    found = F.array_sort(F.array_distinct(F.concat(_tags(F.map_values(col(specs)), tags), from_name)))
    return tx.some(F.array_join(found, ", "))


def security_tags(specs: Column | str) -> Column:
    def any_word(v, words):
        return v.rlike("|".join(words))

    found = _tags(
        F.map_values(col(specs)),
        lambda v: [
            F.when(any_word(v, fx.FINGERPRINT_WORDS), fx.FINGERPRINT_LABEL),
            F.when(any_word(v, fx.FACE_WORDS), fx.FACE_LABEL),
        ],
    )
    return F.coalesce(tx.some(F.array_join(found, ", ")), F.lit(fx.NO_SECURITY_LABEL))


def features(specs: Column | str, name: str = "name", url: str = "url", price: str = "price") -> list[Column]:
    """Every phone feature of one record as columns of a single projection."""
    label = {k: lookup(specs, v) for k, v in fx.SPEC_LABELS.items()}
    return [
        col(name).alias("name"),
        col(url).alias("url"),
        tx.price_digits(price).alias("price"),
        label["chipset"].alias("chipset"),
        cpu(label["chipset"]).alias("cpu"),
        ram_gb(label["ram"]).alias("ram"),
        storage_gb(label["internal_memory"]).alias("internal_memory"),
        screen_inches(label["screen_size"]).alias("screen_size"),
        resolution_text(label["screen_resolution"]).alias("screen_resolution"),
        screen_tech(label["screen_tech"]).alias("screen_tech"),
        refresh_hz(label["refresh_rate"], label["refresh_rate_second"]).alias("refresh_rate"),
        camera_resolution(label["camera"]).alias("camera_main_resolution"),
        camera_count(label["camera"]).alias("camera_count"),
        battery_mah(label["battery"]).alias("battery_capacity"),
        security_tags(specs).alias("security"),
    ]


def camera_mp(c: Column | str) -> Column:
    """Largest integer of the text, so '12.2 MP' gives 12."""
    return F.array_max(F.transform(tx.digit_runs(c), lambda x: x.try_cast("int")))


def normal_resolution(c: Column | str) -> Column:
    """'nK' through the table; exactly two integers as 'small x large'; else NULL."""
    lowered = F.lower(tx.strip(c))
    k = extract(lowered, K_VALUE)
    label = F.concat(
        F.when(k.contains("."), k.try_cast("double").cast("string")).otherwise(k.try_cast("long").cast("string")),
        F.lit("K"),
    )
    table = F.create_map(*[F.lit(x) for n, (w, h) in fx.K_RESOLUTIONS.items() for x in (n, f"{w} x {h}")])
    sides = F.sort_array(F.transform(tx.digit_runs(lowered), lambda x: x.try_cast("long")))
    two = F.when(F.size(sides) == 2, F.concat_ws(" x ", sides[0].cast("string"), sides[1].cast("string")))
    return F.when(k.isNotNull(), F.try_element_at(table, label)).otherwise(two)


def sides(c: Column | str) -> tuple[Column, Column]:
    """'a x b' to two numbers."""
    parts = F.split(col(c), " x ")
    return F.get(parts, F.lit(0)).try_cast("double"), F.get(parts, F.lit(1)).try_cast("double")


def operating_system(brand: Column | str) -> Column:
    return F.when(col(brand) == "Apple", "iOS").otherwise("Android")


def chip_model(c: Column | str) -> Column:
    """First chip rule with a model; else any 'word number'; else the squeezed text."""
    lowered = F.lower(col(c))
    hits = []
    for pattern, template in fx.CHIP_RULES:
        before, after = template.split("{0}")
        model = tx.some(F.trim(extract(lowered, pattern), F.lit(" \t\r\n")))
        hits.append(
            F.when(
                model.isNotNull(),
                F.struct(F.lit(before).alias("before"), model.alias("model"), F.lit(after).alias("after")),
            )
        )
    named = F.transform(
        F.array(F.coalesce(*hits)),
        lambda h: F.concat(
            h["before"],
            F.when(h["model"].startswith("g"), F.upper(h["model"])).otherwise(h["model"]),
            h["after"],
        ),
    )
    general = F.regexp_replace(extract(lowered, fx.CHIP_GENERAL, 0), tx.UNICODE_NOCASE + fx.CHIP_GENERAL, "$1 $2")
    capitalised = F.concat(F.upper(F.left(general, F.lit(1))), F.substring(general, 2, 1_000_000))
    return F.coalesce(F.get(named, F.lit(0)), capitalised, F.when(col(c) != "", tx.squeeze(c)), F.lit("Unknown"))
