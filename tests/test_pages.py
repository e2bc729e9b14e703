from pyspark.sql import functions as F

from shelfwise.functions import dom
from shelfwise.functions import markup as mk
from shelfwise.operators import pages as pg

BASE, HOST = "https://s.example", "s.example"


def rows_of(df):
    return sorted((r.url, r.name, r.price_raw, r.price_vnd) for r in df.collect())


def test_link_layout(spark):
    html = """<ul><li><a href="/tai-nghe-chup-tai-a.html"><img></a><h3>Tai A</h3><div class="box-Gia">1.200.000 ₫</div></li>
    <li><a href="/tai-nghe/jbl.html">danh mục</a></li>
    <li><a href="/tai-nghe-bluetooth-b.html"><h2>Tai B</h2><p class="old-price">giảm</p><p class="amount">990.000đ</p></a></li>
    <li><a href="/tai-nghe-gaming-c.html">Tai C 350.000</a></li>
    <li><a href="/tai-nghe-chup-tai-a.html">again</a></li></ul>"""
    pages = spark.createDataFrame([(html,)], "html string")
    assert rows_of(pg.listing_rows_from_links(pages, "x", BASE, HOST)) == [
        (f"{BASE}/tai-nghe-bluetooth-b.html", "Tai B", "990.000đ", 990000),
        (f"{BASE}/tai-nghe-chup-tai-a.html", "Tai A", "1.200.000 ₫", 1200000),
        # Its nearest ancestor with a heading is the list, whose first heading and price count.
        (f"{BASE}/tai-nghe-gaming-c.html", "Tai A", "1.200.000 ₫", 1200000),
    ]
    alone = spark.createDataFrame([('<ul><li><a href="/tai-nghe-gaming-c.html">Tai C 350.000</a></li></ul>',)], "html string")
    assert rows_of(pg.listing_rows_from_links(alone, "x", BASE, HOST)) == [(f"{BASE}/tai-nghe-gaming-c.html", "Tai C 350.000", "350.000", 350000)]


def test_card_of_a_link_is_its_nearest_ancestor_with_a_heading(spark):
    card = '<div class="card"><h3>{n} before</h3><div><span><a href="/tai-nghe-gaming-{n}.html">x</a></span></div><i class="Price">{p}.000.000</i></div>'
    after = '<div><div><a href="/tai-nghe-gaming-{n}.html">y</a></div><div><h2>no</h2><h3>{n} after</h3></div><b class="amount">{p}.000.000</b></div>'
    deep = "<section><h3>far</h3>" + "<div>" * 6 + '<a href="/tai-nghe-gaming-deep.html">own 7.000.000</a>' + "</div>" * 6 + "</section>"
    html = card.format(n="a", p=1) + after.format(n="b", p=2) + card.format(n="c", p=3) + deep
    pages = spark.createDataFrame([(f"<body>{html}</body>",)], "html string")
    assert rows_of(pg.listing_rows_from_links(pages, "x", BASE, HOST)) == [
        (f"{BASE}/tai-nghe-gaming-a.html", "a before", "1.000.000", 1000000),
        (f"{BASE}/tai-nghe-gaming-b.html", "b after", "2.000.000", 2000000),
        (f"{BASE}/tai-nghe-gaming-c.html", "c before", "3.000.000", 3000000),
        (f"{BASE}/tai-nghe-gaming-deep.html", "own 7.000.000", "7.000.000", 7000000),
    ]


def test_card_text_goes_to_its_own_end(spark):
    card = '<div class="product-card"><a href="/p1"><h3>Tai <span>X <span>Pro</span></span> 2</h3></a><div class="css-1b0tqk2"><div>Giá</div> <div>1.500.000đ</div></div></div>'
    pages = spark.createDataFrame([(card,)], "html string")
    assert rows_of(pg.listing_rows_from_cards(pages, "c", BASE, pg.CARD_LAYOUT)) == [(f"{BASE}/p1", "Tai X Pro 2", "1.500.000đ", 1500000)]


def test_price_rules_by_rank(spark):
    pages = [
        '<b class="price">9.000.000</b><div class="x product-info"><p><i class="box-price">2.000.000</i></p></div>',
        '<b class="price">9.000.000</b><i class="p-price">3.000.000</i>',
        '<b class="price">0.000</b><b class="price">5.500</b><b class="price">7.700</b>',
        '<b class="old-price">liên hệ</b><div class="product-detail"><i class="price">12</i></div><b class="sale-price">4.000.000</b>',
        '<div class="price"><div>giá</div><div>6.100.000 ₫</div></div>',
    ]
    df = spark.createDataFrame([(k, p) for k, p in enumerate(pages)], "k int, html string")
    got = df.select("k", pg.detail_price("html", mk.visible_lines("html")).alias("p")).orderBy("k").select("p.vnd").collect()
    assert [r[0] for r in got] == [2000000, 3000000, 7700, 12, 6100000]


def test_card_layouts(spark):
    block = """<div class="big proloop-block"><div class="proloop-img"><a href="/p1"><img></a></div>
    <h3 class="proloop-name"><a href="/p1">Sony X in-ear</a></h3><b class="proloop-price--highlight">2.000.000₫</b></div>
    <div class="proloop-block-note">no card</div>"""
    card = "<div class='product-card'><a href='/p2'>Q<h4>JBL over-ear Gaming</h4></a><i class='css-1b0tqk2'>Liên hệ</i></div>"
    blocks = spark.createDataFrame([(block,)], "html string")
    cards = spark.createDataFrame([(card,)], "html string")
    first = pg.listing_rows_from_cards(blocks, "b", BASE, pg.BLOCK_LAYOUT)
    second = pg.listing_rows_from_cards(cards, "c", BASE, pg.CARD_LAYOUT)
    assert rows_of(first) == [(f"{BASE}/p1", "Sony X in-ear", "2.000.000₫", 2000000)]
    assert rows_of(second) == [(f"{BASE}/p2", "JBL over-ear Gaming", "Liên hệ", 0)]
    traits = [(r.brand, r.type, r.is_gaming) for r in first.unionByName(second).collect()]
    assert traits == [("Sony", "in-ear", 0), ("JBL", "over-ear", 1)]


def test_label_on_the_last_line_tells_nothing(spark):
    df = spark.createDataFrame([(["x", "Trọng lượng"],), (["TRỌNG LƯỢNG: ", "250 g"],), ([],)], "lines array<string>")
    got = [r[0] for r in df.select(mk.following_line("lines", ["Trọng lượng"])).collect()]
    assert got == [None, "250 g", None]


def test_detail_price_prefers_price_elements(spark):
    pages = ["<p>Mã 1.000.000</p><span class='price'>5.000</span><b class=\"special-price\">2.990.000đ</b>", "<p>cũ 50.000.001.000, 1.234.000 đ</p>", "<p>-</p>"]
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    got = df.select(pg.detail_price("html", mk.visible_lines("html")).alias("p")).select("p.raw", "p.vnd").collect()
    assert [tuple(r) for r in got] == [("2.990.000đ", 2990000), ("1.234.000 đ", 1234000), (None, None)]


def test_merge_rules(spark):
    listing = spark.createDataFrame(
        [("u1", "Chụp tai mic", "", 0, "old"), ("u2", "n", "1đ", 5, "old")],
        "url string, name string, price_raw string, price_vnd long, brand string",
    )
    details = spark.createDataFrame(
        [("u1", "", "cáp", 3, 2.5, "9đ", 9), ("u2", "new", "", None, None, "8đ", 8)],
        "url string, page_brand string, page_connection string, page_battery_life_hours long, page_weight_gram double, page_raw string, page_vnd long",
    )
    first = {r.url: r for r in pg.merge_details(listing, details, overwrite_empty=True).collect()}
    assert (first["u1"].price_vnd, first["u1"].brand, first["u1"].type) == (9, "", "over-ear")
    assert (first["u2"].price_vnd, first["u2"].brand, first["u2"].type) == (5, "old", None)
    other = {r.url: r for r in pg.merge_details(listing, details, overwrite_empty=False).collect()}
    assert (other["u1"].brand, other["u1"].connection, other["u1"].price_vnd) == ("old", "cáp", 0)
    assert other["u2"].brand == "new"


def test_table_and_section_specs(spark):
    table = "<table><tr><td>Mẫu:</td><td>A</td></tr><tr><td colspan=2>Pin</td></tr><tr><td>Giờ</td><td>5<br>7</td></tr><tr><td>Trống</td></tr></table>"
    sheet = '<div class="technical-content-section"><p class="title">Màn</p><table><tr><td>k</td><td>1</td></tr><tr><td>k</td><td>2</td></tr></table></div>'
    df = spark.createDataFrame([(table, sheet)], "a string, b string")
    row = df.select(mk.table_specs("a").alias("t"), mk.sectioned_specs("b").alias("s")).first()
    assert [(s.category, s.details) for s in row.t] == [("Thông tin chung", {"Mẫu": "A"}), ("Pin", {"Giờ": "5 | 7"})]
    assert [(s.category, s.details) for s in row.s] == [("Màn", {"k": "2"})]


def test_nested_tables_sections_and_paragraphs(spark):
    inner = "<table><tr><td>x</td><td>1</td></tr></table>"
    table = f"<table><tr><td>Chung</td></tr><tr><td><p>A</p><p>B</p></td><td><div>a<div>b</div>c</div>d</td></tr><tr><td>T</td><td>{inner}</td></tr></table>"
    sheet = (
        '<div class="technical-content-section"><div><p class="big title">Màn <b>hình</b></p></div><div><div>x</div></div>'
        '<table><tr><td>k<td>1<tr><td>m</td><td><div>2</div><div>3</div></td></table></div>'
        '<p class="title">none</p><table><tr><td>out</td><td>side</td></tr></table>'
    )
    df = spark.createDataFrame([(table, sheet)], "a string, b string")
    row = df.select(mk.table_specs("a").alias("t"), mk.sectioned_specs("b").alias("s")).first()
    assert [(s.category, s.details) for s in row.t] == [("Chung", {"A\nB": "ab | c | d", "T": "x1", "x": "1"})]
    assert [(s.category, s.details) for s in row.s] == [("Màn hình", {"k": "1", "m": "2 | 3"})]


def test_elements_end_at_their_own_end(spark):
    page = "<div id=a><p>one<p>two<div>in</div></div><ul><li>1<ul><li>2</ul><li>3</ul></b><br/>tail<i>open"
    df = spark.createDataFrame([(page,), ("",), ("no tags < here",), (None,)], "h string")
    read = df.select(dom.on_page("h", lambda t, n: F.transform(n, lambda x: F.struct(x["name"], mk.text_of(t, x), x["parent"], x["size"]))).alias("n"))
    rows = [r.n for r in read.collect()]
    assert [tuple(x) for x in rows[0]] == [
        ("div", "onetwoin", -1, 3), ("p", "one", 0, 0), ("p", "two", 0, 0), ("div", "in", 0, 0),
        ("ul", "123", -1, 4), ("li", "12", 4, 2), ("ul", "2", 5, 1), ("li", "2", 6, 0), ("li", "3", 4, 0), ("br", "", -1, 0), ("i", "open", -1, 0),
    ]
    assert rows[1:] == [[], [], []]


def test_long_and_unclosed_tags(spark):
    pages = [
        '<a href="/k" title="' + "t" * 1_000_000 + '">one</a>',
        "<a " + "x" * 20_000,
        "<a href=" + "/v" * 3_000 + ">two",
        "<a " * 100_000 + "href=/w>three</a>",
        '<a x="' * 20_000,
        "<p title='<a href=/no>'>t</p><a class='>' href=/yes>four",
    ]
    df = spark.createDataFrame([(k, p) for k, p in enumerate(pages)], "k int, html string")
    got = [[(x.href, x.label) for x in r.links] for r in df.select("k", mk.links("html").alias("links")).orderBy("k").collect()]
    assert got == [[("/k", "one")], [], [("/v" * 3_000, "two")], [("/w", "three")], [], [("/yes", "four")]]
    sizes = df.select("k", dom.on_page("html", lambda t, n: F.size(n)).alias("n")).orderBy("k").collect()
    assert [r.n for r in sizes] == [1, 0, 1, 1, 0, 2]


def test_time_grows_with_the_page(spark):
    many = ("<div class='c'><a href=/x><img></a><h3>t</h3><p>x</p></div>") * 3_000 + "<div>" * 500
    df = spark.createDataFrame([(many,)], "h string")
    assert df.select(dom.on_page("h", lambda t, n: F.size(n))).first()[0] == 15_500


def test_references_decode_like_the_public_rules(spark):
    import html

    texts = [
        "&amp;#65; &lt;b&gt; &eacute;&#233;&#xE9;&#x1F600; &#9999999; &#55357; &#0; &#99999999999; &nosuch; a & b &",
        "&#150;&hellip;&nbsp;|", "none", "&copy;&#x110000;&&amp;",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(mk.unescape("t")).collect()] == [html.unescape(t) for t in texts]


def test_links_in_all_quote_forms_and_unclosed(spark):
    page = """<a href="/a b's.html">one</a><a href='/x"y'>two<a class=k href=/plain>three</a><a data-href="/no">no</a><a href="/last">four"""
    df = spark.createDataFrame([(page,)], "t string")
    got = [(x.href, x.label) for x in df.select(mk.links("t")).first()[0]]
    assert got == [("/a b's.html", "one"), ('/x"y', "two"), ("/plain", "three"), ("/last", "four")]
