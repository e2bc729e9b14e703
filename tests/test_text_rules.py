"""One example per text rule; the expected values follow from the rule definitions."""

import pytest
from pyspark.sql import functions as F

from shelfwise.fixed_values import BRAND_WORDS, K_RESOLUTIONS, PRICE_EDGES, PRICE_LABELS
from shelfwise.functions import headphone as hp
from shelfwise.functions import markup as mk
from shelfwise.functions import numeric as nm
from shelfwise.functions import phone as ph
from shelfwise.functions import specs as sp
from shelfwise.functions import text as tx
from shelfwise.functions import urls
from shelfwise.operators import lookup

CASES = [
    ("price A", tx.price_digits, {"28.990.000đ": 28990000, "Liên hệ": None, "": None, "...": None, None: None}),
    ("price B", tx.price_or_zero, {"9.985.000₫": 9985000, "": 0, "Liên hệ": 0, "9.985.000 8.000": 99850008000, None: 0}),
    ("fragment", tx.price_fragment, {"Giá 1.200.000 ₫ cũ 2": "1.200.000 ₫", "x": None}),
    ("ram", ph.ram_gb, {"8 GB": 8.0, "12": 12.0, "6.5g": 6.5, "không": None, "3gbps 4 GB": 3.0}),
    ("rom", ph.storage_gb, {"1TB": 1024.0, "256 GB": 256.0, "512": 512.0, "128GB hoặc 1 t": 1024.0}),
    ("inches", ph.screen_inches, {"6.7 inches": "6.7", "6.7 inch": "6.7", "6,7 inches": "6,7", "lớn": None}),
    ("to number", nm.to_number, {"6,7": None, "6.7": 6.7, "1d": None, " 12 ": 12.0, "1e3": 1000.0, "abc": None}),
    ("resolution", ph.resolution_text,
     {"1080 x 2400 px": "1080 x 2400", "1.5K": "1.5K", "Full HD+": "Full HD", "lạ": "lạ", "": None, None: None}),
    ("tech", ph.screen_tech, {"Màn chính: OLED, màn phụ: LCD": "OLED", "MÀN CHÍNH : IPS": "IPS", "TFT": "TFT", "": None}),
    ("camera text", ph.camera_resolution, {"50 MP + 12.2 mp": "50.0 MP", "dual": None, None: None}),
    ("camera count", ph.camera_count, {"50 MP + 12.2 mp": 2, "dual": 0, None: None, "": None}),
    ("camera int", ph.camera_mp, {"50.0 MP": 50, "12.2 MP": 12, "0.3 MP": 3, "x": None}),
    ("battery", ph.battery_mah, {"5.000  mAh": 5000, "4,500 MAH Li": 4500, "10 giờ": None, "": None}),
    ("normal resolution", ph.normal_resolution,
     {"2400 x 1080": "1080 x 2400", "2K": "2560 x 1440", "2.50k": "2880 x 1620", "1.5K": None, "HD+": None,
      "720 x 1600 x 3": None, None: None}),
    ("chip", ph.chip_model,
     {"Snapdragon 8 Elite": "Snapdragon 8 elite", "Helio A22": "A22 Bionic", "SM8450": "M8450", "": "Unknown",
      None: "Unknown", "Helio G85": "Helio G85", "Tensor G3": "Tensor G3", "Unisoc T606": "Unisoc t606",
      "Dimensity 7300 Ultra": "Dimensity 7300 ultra", "intel 3560 lite": "Intel 3560 ", "z3560": "Z356 0", "chip  lạ": "chip lạ"}),
    ("name", tx.clean_name, {"  A (x) B [y]  C ": "A B C", None: None}),
    ("chipset", tx.clean_chipset, {"Vân-tay (x) 8": "Vântay 8"}),
    ("connector", hp.connector,
     {"Jack 3.5 mm": "3.5mm", "USB Type C": "Type C", "USB 2.0": "USB-A", "Wireless": "Bluetooth", "usb-c": "Type C",
      "x" * 21: None, "HDMI": None, "  ": None, None: None}),
    ("grams", nm.grams, {"250 g": 250.0, "0.25 kg": None, "12,5G": 12.5, "1.2.3 g": None}),
    ("hours", nm.largest_integer, {"30 giờ (ANC), 50 giờ": 50, "không": None}),
    ("clock", lambda c: nm.clock_text(F.col(c).cast("double")), {"3661.9": "01:01:01", "-5": "00:00:00", "360000": "100:00:00"}),
    ("band", lambda c: nm.band(F.col(c).cast("long"), PRICE_EDGES, PRICE_LABELS),
     {"2999999": "Low", "3000000": "Medium", "8000000": "High", "15000000": "Premium", None: None}),
    ("brand", lambda c: lookup.by_ordered_words(c, BRAND_WORDS),
     {"Redmi Note": "Xiaomi", "Điện thoại Samsung": "Samsung", "Abc": "Other", None: "Other", "Sony vs iPhone": "Sony",
      "x sony iphone": "Apple"}),
    ("reason", tx.before_colon, {"EMS: BACK PAINS/INJURY": "EMS", "Fire": "Fire"}),
    ("brand guess", hp.brand_guess, {"Tai nghe Sony": "Tai", "Chụp JBL": "JBL", "ă b": "", None: ""}),
    ("slug", urls.slug, {"https://s.example/a/b-c.html": "b-c"}),
    ("absolute", lambda c: urls.absolute_url("https://s.example/", c),
     {"/a": "https://s.example/a", "b/c": "https://s.example/b/c", "//o.example/x": "https://o.example/x",
      "http://o.example": "http://o.example", "#t": "https://s.example#t", "?q=1": "https://s.example?q=1",
      "../d": "https://s.example/d", "javascript:;": "javascript:;"}),
    ("page 1", lambda c: urls.page_url(c, 1), {"https://s.example/a?x=1": "https://s.example/a?x=1"}),
    ("page 2", lambda c: urls.page_url(c, 2),
     {"https://s.example/a": "https://s.example/a?page=2", "https://s.example/a?x=1&page=9#f": "https://s.example/a?x=1&page=2#f",
      "https://s.example/a?x=&y=2": "https://s.example/a?y=2&page=2"}),
    ("appended page", lambda c: urls.appended_page_url(c, 2), {"a": "a?page=2", "a?b=1": "a?b=1&page=2"}),
    ("search", lambda c: urls.search_url("https://s.example", "/search", c), {"tai nghe": "https://s.example/search?q=tai%20nghe"}),
    ("product url", lambda c: urls.is_product_url(c, "s.example"),
     {"https://s.example/tai-nghe-chup-tai-sony.html": True, "https://s.example/tai-nghe/jbl.html": False,
      "https://s.example/tai-nghe-abc.html": False, "https://s.example/tai-nghe-khong-day-xyz.html": True,
      "https://o.example/tai-nghe-chup-tai-x.html": False, None: False}),
    ("list value", sp.list_as_text, {'["a","b"]': "a | b", "[x": "[x", "c": "c"}),
    ("cell", tx.cell_value, {" a \n\n b ": "a | b", " a ": "a"}),
    ("label", tx.label_key, {" RAM: ": "ram"}),
    ("lines", mk.visible_lines,
     {"<p>a&amp;b<br>c</p><script>x</script><!-- n --><b> d&#8363; </b>": ["a&b", "c", "d₫"]}),
    ("links", lambda c: F.to_json(mk.links(c)),
     {"<a href='/x'>one</a><a class=k href=\"/y?a=1&amp;b=2\"><b>t</b>wo</a><a href=/x>again</a>":
      '[{"href":"/x","label":"one"},{"href":"/y?a=1&b=2","label":"two"}]'}),
    ("security", lambda c: ph.security_tags(F.create_map(F.lit("k"), F.col(c))),
     {"Vân tay, FACE ID": "Face ID, Vân tay", "mã": "Mật khẩu", None: "Mật khẩu"}),
    ("wireless", lambda c: ph.wireless_tags(F.create_map(F.lit("k"), F.col(c)), F.lit("Máy 5G")),
     {"Wi-Fi 6, Bluetooth 5.3, LTE": "4G, 5G, Bluetooth 5.3, WiFi 6", None: "5G"}),
]


@pytest.mark.parametrize("name,build,table", CASES, ids=[c[0] for c in CASES])
def test_rule(values, name, build, table):
    assert values(build, list(table)) == list(table.values())


def test_resolution_class_ties_and_gaps(spark):
    df = spark.createDataFrame([(1080.0, 2400.0), (None, None), (1280.0, 720.0), (1600.0, 900.0)], "w double, h double")
    got = [r[0] for r in df.select(lookup.nearest(["w", "h"], K_RESOLUTIONS)).collect()]
    assert got == ["HD", "Unknown", "HD", "HD"]


def test_specs_last_key_wins_and_error_records(spark):
    rows = [
        '{"url":"a","specifications":[{"category":"c","details":{"RAM":"8 GB","X":["p","q"]}},{"category":"d","details":{"ram":"12 GB"}}]}',
        '{"url":"b","error":"boom","specifications":{},"variant_prices":[]}',
    ]
    from shelfwise.sources.readers import PRODUCT_SCHEMA

    df = spark.createDataFrame([(r,) for r in rows], "j string").select(F.from_json("j", PRODUCT_SCHEMA).alias("p"))
    got = {r[0]: r[1] for r in df.select("p.url", sp.merged_specs("p.specifications")).collect()}
    assert got == {"a": {"ram": "12 GB", "x": "p | q"}, "b": {}}


def test_half_even_rounding(values):
    assert values(lambda c: nm.round_half_even(F.col(c).cast("double"), 2), ["0.125", "0.375", "2.5"]) == [0.12, 0.38, 2.5]
