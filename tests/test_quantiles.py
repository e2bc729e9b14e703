import numpy as np
import pandas as pd
import pytest

from shelfwise.operators import impute, quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.77, 0.9, 1.0]


@pytest.fixture(scope="module")
def skewed():
    """One group holds nine tenths of the rows; a third of the values are equal."""
    rng = np.random.default_rng(1)
    n = 30_000
    return pd.DataFrame(
        {
            "g": rng.choice(["a", "b", "c"], n, p=[0.9, 0.0995, 0.0005]),
            "x": np.where(rng.random(n) < 0.3, 5.0, rng.normal(size=n) * 10),
            "y": rng.integers(0, 3, n).astype(float),
        }
    )


@pytest.mark.parametrize("direct,steps", [(1_000_000, 1000), (100, 1000), (50, 20)])
def test_every_narrowing_depth_is_exact(spark, skewed, direct, steps):
    df = spark.createDataFrame(skewed).repartition(5)
    got = quantiles.exact_quantiles(df, ["x", "y"], PROBS, ["g"], direct_rows=direct, steps=steps).collect()
    assert len(got) == 6
    for r in got:
        v = skewed[skewed.g == r["g"]][r["metric"]]
        assert r["n"] == len(v)
        np.testing.assert_allclose([r[f"q{i}"] for i in range(len(PROBS))], np.quantile(v, PROBS), rtol=1e-12)


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (4.0,)], "x double")
    row = quantiles.exact_quantiles(df, ["x"], [0.5]).first()
    assert (row["n"], row["q0"]) == (2, 2.5)


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "t string")
    assert quantiles.exact_modes(df, ["t"]).first()["mode"] == "a"


def test_equal_band_edges_are_an_error(spark):
    df = spark.createDataFrame([(1.0,)] * 9 + [(2.0,)], "x double")
    with pytest.raises(Exception, match="not unique"):
        impute.quantile_bands(df, "x", ["l", "m", "h"], "band").collect()


def test_group_fill_guard_and_overall(spark):
    rows = [("a", 1.0), ("a", 3.0), ("a", 5.0), ("a", None), ("b", 100.0), ("b", None), (None, None)]
    df = spark.createDataFrame(rows, "g string, x double")
    filled = impute.fill_group_medians(df, "g", ["x"], min_values=3)
    got = sorted((r["g"] or "", r["x"]) for r in filled.collect())
    # b has too few values; it and the row without group take the median of 1, 3, 5, 3, 100.
    assert got == [("", 3.0), ("a", 1.0), ("a", 3.0), ("a", 3.0), ("a", 5.0), ("b", 3.0), ("b", 100.0)]


def test_group_modes(spark):
    rows = [("a", "x"), ("a", "x"), ("a", None), ("b", None), (None, None)]
    df = spark.createDataFrame(rows, "g string, t string")
    got = sorted((r["g"] or "", r["t"]) for r in impute.fill_group_modes(df, "g", ["t"]).collect())
    assert got == [("", "x"), ("a", "x"), ("a", "x"), ("a", "x"), ("b", "Unknown")]
