"""The registered queries against their SQL, and what their plans may not contain."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "part orders lineitem events documents embeddings pages conversations customer supplier".split()
SAMPLE = [
    "s5_multi_source_load", "p10_completeness_rule", "p15_product_url", "d1_keep_first_url", "u1_union_by_name",
    "k4_top_values", "j3_keep_top_members", "j7_brand_rules", "a6_describe", "a9_missing_ratio_by_group",
    "a17_correlation_matrix", "a20_pivot_counts", "w2_guarded_group_median", "w5_group_mode", "f16_all_features",
    "f21_chip_model", "n6_round_two_places", "dt3_weekday", "m1_merged_specs", "g2_page_links", "g3_listing_rows",
    "g6_merge_details_first_shop", "e2_one_hot_drop_first", "e4_label_codes", "c2_automatic_histogram",
    "c6_box_stats_by_group", "x5_headphone_table", "x7_call_calendar",
]
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]


@pytest.fixture(scope="module")
def db(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "-"
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(SAMPLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, folder, db, name):
    df = entry.queries()[name](spark, folder)
    got = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FORBIDDEN if word in plan]
    assert "No Partition Defined" not in plan
    cursor = db.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = [dict(zip(names, r)) for r in cursor.fetchall()]
    order = sorted(names)
    assert sorted(tuple(cell(r[n]) for n in order) for r in got) == sorted(
        tuple(cell(r[n]) for n in order) for r in want
    )


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_filters_and_columns_reach_the_scan(spark, folder):
    plan = entry.queries()["p9_range_filter"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_totalprice" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_keep_first_combines_before_the_shuffle(spark, folder):
    plan = entry.queries()["w7_keep_first_in_key"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min_by") > plan.index("Exchange")
