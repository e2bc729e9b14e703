import pytest

from shelfwise.functions import phone
from shelfwise.sources import readers, writers


def test_nested_array_file_and_links(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        '[\n {"url": "a", "name": "n", "price": "1đ", "specifications": [{"category": "c", "details": {"k": ["x", "y"]}}]},\n'
        ' {"url": "b", "error": "e", "specifications": {}, "variant_prices": []}\n]',
        encoding="utf-8",
    )
    got = {r.url: r for r in readers.read_products(spark, str(tmp_path / "p.json"), array_file=True).collect()}
    assert got["a"].specifications[0].details["k"].replace(" ", "") == '["x","y"]'
    assert got["b"].specifications is None and got["b"].error == "e"
    (tmp_path / "l.csv").write_text("﻿Product Link\nhttps://s.example/a\n", encoding="utf-8")
    assert [r[0] for r in readers.read_links(spark, str(tmp_path / "l.csv")).collect()] == ["https://s.example/a"]


def test_latest_file_per_prefix_and_missing_source(spark, tmp_path):
    for name in ("a_20240101.csv", "a_20240301.csv", "b_20240201.csv", "c.txt"):
        (tmp_path / name).write_text(f"k,v\n1,{name}\n", encoding="utf-8")
    found = readers.latest_paths(spark, str(tmp_path), ["a", "b", "z"])
    assert {k: v.split("/")[-1] for k, v in found.items()} == {"a": "a_20240301.csv", "b": "b_20240201.csv"}
    rows = readers.read_latest(spark, str(tmp_path), ["a", "b", "z"], "k int, v string").collect()
    assert sorted((r.v, r.source_rank) for r in rows) == [("a_20240301.csv", 0), ("b_20240201.csv", 1)]
    with pytest.raises(ValueError, match="none of z"):
        readers.read_latest(spark, str(tmp_path), ["z"], "k int, v string")
    (tmp_path / "empty").mkdir()
    none = readers.read_latest(spark, str(tmp_path / "empty"), ["z"], "k int, v string")
    assert none.count() == 0 and "origin_row" in none.columns


def test_folder_names_are_not_patterns_and_prefixes_are_whole(spark, tmp_path):
    folder = tmp_path / "raw(1)"
    folder.mkdir()
    for name in ("shop_10_20240101.csv", "shop_2_20240101.csv"):
        (folder / name).write_text(f"k,v\n1,{name}\n", encoding="utf-8")
    found = readers.latest_paths(spark, str(folder), ["shop_1", "shop_2", "shop_10"])
    assert sorted(found) == ["shop_10", "shop_2"]


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("url,source,more\nhttp://u,shop,x\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("source,url\nshop2,http://w\n", encoding="utf-8")
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv")]
    schema = "source string, url string, n int"
    rows = sorted(tuple(r) for r in readers.read_csv(spark, paths, schema).collect())
    assert rows == [("shop", "http://u", None), ("shop2", "http://w", None)]
    wide = readers.read_csv(spark, paths, schema, extra=True)
    assert wide.columns == ["source", "url", "n", "more"]
    assert sorted(r.more or "" for r in wide.collect()) == ["", "x"]
    with pytest.raises(ValueError, match="lacks the columns more"):
        readers.read_csv(spark, paths, schema, required=["more"])
    (tmp_path / "c.csv").write_text("source,n\ns,12\ns,twelve\n", encoding="utf-8")
    kept = readers.read_csv(spark, str(tmp_path / "c.csv"), schema, corrupt="_bad").cache()
    assert sorted((r.n or 0, r._bad) for r in kept.collect()) == [(0, "s,twelve"), (12, None)]


def test_files_of_one_folder_with_different_headers(spark, tmp_path):
    folder = tmp_path / "raw [1]"
    folder.mkdir()
    for name, text in {
        "a b.csv": "url,source,n\nhttp://u,shop,1\n",
        "c+d.csv": "source,url\nshop2,http://w\n",
        "e{f}.csv": "url,source,n\nhttp://v,shop3,x\n",
        "g.csv": "",
    }.items():
        (folder / name).write_text(text, encoding="utf-8")
    path = f"{tmp_path}/raw*"
    schema = "source string, url string, n int"
    rows = sorted(tuple(r) for r in readers.read_csv(spark, path, schema, mixed=True).collect())
    assert rows == [("shop", "http://u", 1), ("shop2", "http://w", None), ("shop3", "http://v", None)]
    kept = readers.read_csv(spark, path, schema, corrupt="_bad", mixed=True).collect()
    assert sorted((r.source or "", r.n, r._bad) for r in kept) == [
        ("shop", 1, None), ("shop2", None, None), ("shop3", None, "http://v,shop3,x"),
    ]
    # Without the word a second header is an error, also where lines that cannot be read are kept.
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "a.csv").write_text("url,source\nu,s\n", encoding="utf-8")
    (tmp_path / "two" / "b.csv").write_text("source,url\ns,u\n", encoding="utf-8")
    for corrupt in (None, "_bad"):
        with pytest.raises(Exception, match="(?i)header"):
            readers.read_csv(spark, str(tmp_path / "two"), schema, corrupt=corrupt).collect()
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.csv").write_text("", encoding="utf-8")
    assert readers.read_csv(spark, str(tmp_path / "none"), schema, mixed=True).count() == 0


def test_numbers_beyond_their_type_become_null(spark):
    df = spark.createDataFrame([("99999999999", "60 Hz"), ("120", None)], "a string, b string")
    assert [r[0] for r in df.select(phone.refresh_hz("a", "b")).collect()] == [None, 120]


def test_quoted_cells_and_fixed_columns_round_trip(spark, tmp_path):
    df = spark.createDataFrame([('a "q", b\nc', 1)], "name string, extra int")
    writers.write_fixed(df, str(tmp_path / "out"), ["url", "name"])
    back = readers.read_csv(spark, str(tmp_path / "out"), "url string, name string", multi_line=True).collect()
    assert [tuple(r) for r in back] == [(None, 'a "q", b\nc')]
