import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise import session
from shelfwise.operators import aggregate as agg
from shelfwise.operators import charts, encode, impute, lookup, rows
from shelfwise.session import attach
from shelfwise.sources.tables import table


def test_keep_first_is_idempotent_and_partition_independent(spark, folder):
    lines = table(spark, folder, "lineitem")
    keys, order = ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"]
    results = []
    for n in (1, 7):
        once = rows.keep_first(lines.repartition(n), keys, order)
        twice = rows.keep_first(once, keys, order)
        assert sorted(once.collect()) == sorted(twice.collect())
        results.append(sorted(once.collect()))
    assert results[0] == results[1]


def test_null_keys_are_one_key(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("u", 3)], "url string, i int")
    got = sorted(((r.url or ""), r.i) for r in rows.keep_first(df, ["url"], ["i"]).collect())
    assert got == [("", 1), ("u", 3)]


def test_upsert_prefers_success_then_latest(spark):
    df = spark.createDataFrame(
        [("a", 1, "e", "x"), ("a", 2, None, "y"), ("a", 3, "e", "z"), ("b", 1, "e", "p"), ("b", 2, "e", "q")],
        "url string, attempt int, error string, v string",
    )
    got = {r.url: r.v for r in rows.upsert_latest(df, "url", F.col("error").isNotNull(), "attempt").collect()}
    assert got == {"a": "y", "b": "q"}


@pytest.mark.parametrize("bound", ["-1", "10m"])
def test_attach_gives_the_same_rows_with_and_without_broadcast(spark, folder, bound):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    parts = table(spark, folder, "part")
    counts = parts.groupBy("p_brand").agg(F.count("*").alias("n"))
    joined = attach(parts, counts, ["p_brand"], "left")
    assert joined.count() == parts.count()
    assert joined.where("n is null").count() == 0
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (bound != "-1")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keyword_filter_keeps_missing_names(spark):
    df = spark.createDataFrame([("Apple Watch",), ("PC Sony",), ("pcx",), (None,)], "name string")
    got = [r[0] for r in rows.without_keywords(df, "name", ["watch", "pc "]).collect()]
    assert got == ["pcx", None]


def test_correlation_is_symmetric_and_guards_constants(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("fixed", F.lit(0.1)).withColumn("none", F.lit(None).cast("double"))
    names = ["l_quantity", "l_extendedprice", "fixed", "none"]
    got = {(r.x, r.y): r.r for r in agg.correlation_pairs(lines, names).collect()}
    assert len(got) == 16
    assert all(got[a, b] == got[b, a] for a in names for b in names)
    assert abs(got["l_quantity", "l_quantity"] - 1) < 1e-9
    assert all(got["fixed", n] is None and got["none", n] is None for n in names)


def test_histogram_keeps_every_row_and_empty_bins(spark):
    values = [0.0, 0.1, 0.3, 0.7, 1.0, 1.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r.n for r in charts.histogram(df, "x", 10).orderBy("bin").collect()]
    assert got == list(np.histogram([v for v in values if v is not None], bins=10)[0])


def test_density_matches_the_definition(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=400)
    got = charts.density(spark.createDataFrame([(float(x),) for x in v], "x double"), "x").orderBy("point").collect()
    h = v.std(ddof=1) * len(v) ** -0.2
    grid = np.linspace(v.min(), v.max(), 200)
    want = np.exp(-0.5 * ((v[None, :] - grid[:, None]) / h) ** 2).sum(1) / (len(v) * h * np.sqrt(2 * np.pi))
    np.testing.assert_allclose([r.density for r in got], want, rtol=1e-9)


def test_density_of_far_values_keeps_empty_grid_points(spark):
    v = np.concatenate([np.linspace(0, 1, 40_000), [4000.0]])
    got = charts.density(spark.createDataFrame([(float(x),) for x in v], "x double"), "x").orderBy("point").collect()
    width = v.std(ddof=1) * len(v) ** -0.2
    grid = np.linspace(0, 4000, 200)
    want = np.array([np.exp(-(((v - x) / width) ** 2) / 2).sum() for x in grid]) / (len(v) * width * np.sqrt(2 * np.pi))
    assert [r.point for r in got] == list(range(200)) and (want == 0).any()
    np.testing.assert_allclose([r.density for r in got], want, rtol=1e-9, atol=1e-300)


def test_one_hot_rows_sum_to_at_most_one(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", F.nullif("p_type", F.lit("PROMO")).alias("p_type"))
    wide = encode.one_hot(parts, ["p_type"])
    flags = [c for c in wide.columns if c != "p_partkey"]
    assert flags == [f"p_type_{t}" for t in ["LARGE", "MEDIUM", "SMALL", "STANDARD"]]
    assert wide.select(F.max(sum(F.col(c) for c in flags))).first()[0] == 1


def test_long_one_hot_takes_any_number_of_levels(spark):
    df = spark.createDataFrame([(k, f"v{k % 1500:04d}" if k % 7 else None) for k in range(4000)], "k int, v string")
    got = encode.one_hot_long(df, "k", "v").collect()
    assert len(got) == sum(k % 7 > 0 for k in range(4000))
    names = sorted({r.level for r in got})
    assert all(names[r.code] == r.level for r in got) and len(names) > 1000


def test_levels_of_all_columns_come_from_one_pass(spark):
    rows = [("x", "r", 1), ("x", "s", 1), ("y", None, 2), ("z", "r", None), (None, "t", 2)]
    df = spark.createDataFrame(rows, "a string, b string, c int")
    assert encode.top_levels(df, {"a": 1, "b": 3, "c": 1}) == {
        "a": (["x"], True), "b": (["r", "s", "t"], True), "c": (["1"], True),
    }
    assert encode.top_levels(df.na.drop(), {"a": 2, "b": 2}) == {"a": (["x"], False), "b": (["r", "s"], False)}
    wide = encode.encoded_table(df, rare={"a": 2, "b": 3}, categories=["c"], drop=["a", "b"])
    # The first level in sorted order has no column; rows without a kept level are others.
    assert wide.columns == ["a_grouped_x", "a_grouped_y", "b_grouped_r", "b_grouped_s", "b_grouped_t", "c_2"]
    assert sorted(tuple(r) for r in wide.collect()) == sorted(
        [(1, 0, 1, 0, 0, 0), (1, 0, 0, 1, 0, 0), (0, 1, 0, 0, 0, 1), (0, 0, 1, 0, 0, 0), (0, 0, 0, 0, 1, 1)]
    )
    assert "Join" not in wide._jdf.queryExecution().executedPlan().toString()
    empty = encode.encoded_table(df.limit(0), rare={"a": 2}, categories=["c"], drop=["a", "b"])
    assert empty.columns == [] and empty.count() == 0


def test_too_many_levels_are_refused_unless_given(spark):
    df = spark.range(30).selectExpr("id as k", "cast(id as string) as v")
    assert len(encode.one_hot(df, ["v"], drop_first=False, most=30).columns) == 31
    with pytest.raises(ValueError, match="more than 29 levels"):
        encode.one_hot(df, ["v"], most=29)
    assert encode.one_hot(df, ["v"], drop_first=False, levels={"v": ["3"]}, most=29).columns == ["k", "v_3"]


def test_repeated_keys_do_not_repeat_rows(spark):
    df = spark.createDataFrame([("a", None), ("b", "x"), ("c", None)], "k string, v string")
    fill = spark.createDataFrame([("a", "1"), ("a", "2"), ("a", None)], "k string, f string")
    got = {r.k: r.v for r in lookup.backfill(df, "k", "v", fill).collect()}
    assert got == {"a": "2", "b": "x", "c": None}


def test_equal_band_edges_can_be_merged(spark):
    df = spark.createDataFrame([(float(v),) for v in [5] * 20 + [1, 9]], "v double")
    got = {(r.v, r.b) for r in impute.quantile_bands(df, "v", ["low", "mid", "high"], "b", merge_equal=True).collect()}
    assert got == {(1.0, "low"), (5.0, "low"), (9.0, "high")}


def test_scratch_scope_leaves_nothing(spark):
    with session.scratch(spark) as folder:
        stored = session.hand_off(spark.range(10), "part")
        assert stored.count() == 10 and os.path.exists(folder)
    assert not os.path.exists(folder)


def test_label_codes_number_sorted_levels(spark):
    levels = [f"v{i:04d}" for i in range(3000)]
    df = spark.createDataFrame([(x,) for x in reversed(levels)], "t string").repartition(6)
    got = {r.t: r.c for r in encode.label_codes(df, "t", "c").collect()}
    assert got == {x: i for i, x in enumerate(levels)}


def test_components_match_an_eigen_decomposition(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 3)) @ np.array([[3, 1, 0], [0, 2, 1], [0, 0, 0.5]])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double, c double")
    got = np.array([[r.pc_1, r.pc_2] for r in encode.two_components(df, ["a", "b", "c"], ["id"]).orderBy("id").collect()])
    z = (x - x.mean(0)) / x.std(0)
    _, _, vt = np.linalg.svd(z - z.mean(0), full_matrices=False)
    for j in range(2):
        axis = vt[j] * np.sign(vt[j][np.abs(vt[j]).argmax()])
        np.testing.assert_allclose(got[:, j], z @ axis, atol=1e-6)


def test_scaling_zero_variance_gives_zero(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, b double")
    got = encode.standard_scaled(df, ["a", "b"]).orderBy("a").collect()
    assert [tuple(r) for r in got] == [(-1.0, 0.0), (1.0, 0.0)]


def test_row_audit_by_observation(spark, folder):
    watched, seen = agg.observed(table(spark, folder, "part"), "parts")
    watched.where("p_size > 10").write.format("noop").mode("overwrite").save()
    assert seen.get["n_rows"] == table(spark, folder, "part").count()


def test_unseen_and_backfill(spark):
    batch = spark.createDataFrame([("a", None), ("b", "k")], "name string, v string")
    seen = spark.createDataFrame([("a",), ("a",)], "name string")
    assert [r.name for r in lookup.unseen(batch, seen, "name").collect()] == ["b"]
    got = {r.name: r.v for r in lookup.backfill(batch, "name", "v", {"a": "new", "b": "never"}).collect()}
    assert got == {"a": "new", "b": "k"}


def test_step_audit_counts_in_one_pass_also_without_rows(spark, tmp_path):
    for rows, want in (([(1,), (2,), (None,)], (3, 2, 1)), ([], (0, 0, 0))):
        folder = str(tmp_path / str(len(rows)))
        spark.createDataFrame(rows, "v int").write.parquet(folder)
        for before in (spark.read.parquet(folder), spark.createDataFrame(rows, "v int")):
            assert tuple(agg.step_audit(before, lambda df: df.where("v is not null")).first()) == want
