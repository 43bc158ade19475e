"""Order statistics, profiles and chart data against numpy."""

import math

import numpy as np
import pytest

from featloom.operators import order_stats as os_
from featloom.operators import profile


def trim_mean(v, p=0.1):
    v, k = np.sort(v), int(p * len(v))
    return v[k:len(v) - k].mean()


CASES = {
    "uniform": np.random.default_rng(0).uniform(-5, 5, 3001),
    "heavy tail": np.exp(np.random.default_rng(1).normal(0, 12, 2000)),
    "ties": np.random.default_rng(2).integers(0, 7, 4000).astype(float),
    "one third equal": np.r_[np.full(1000, 3.25), np.random.default_rng(3).normal(0, 1, 2000)],
    "constant": np.full(50, 2.0),
    "two": np.array([1.0, 2.0]),
    "single": np.array([4.5]),
    "wide": np.array([-1e308, 0.0, 1.0, 2.0, 1e308]),
}


@pytest.fixture(scope="module")
def values(spark):
    rows = [(name, float(x)) for name, v in CASES.items() for x in v]
    return spark.createDataFrame(rows, "column string, value double").repartition(4)


@pytest.mark.parametrize("rank_rows", [1_000_000, 40])
def test_quantiles_are_exact(values, rank_rows):
    got = os_.quantiles(values, ["column"], {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p99": 0.99}, rank_rows=rank_rows)
    for r in got.collect():
        v = CASES[r["column"]]
        if r["column"] == "wide":
            continue
        for name, p in (("p10", 0.1), ("p25", 0.25), ("p50", 0.5), ("p99", 0.99)):
            assert r[name] == pytest.approx(np.quantile(v, p), rel=1e-12), (r["column"], name)


@pytest.mark.parametrize("rank_rows", [1_000_000, 40])
def test_robust_summary(values, rank_rows):
    out = {r["column"]: r for r in os_.robust_summary(values.where("column <> 'wide'"), ["column"], rank_rows=rank_rows).collect()}
    for name, v in CASES.items():
        if name == "wide":
            continue
        r = out[name]
        med = np.median(v)
        mad = np.median(np.abs(v - med))
        q1, q3 = np.quantile(v, [0.25, 0.75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert r["n"] == len(v) and r["median"] == pytest.approx(med)
        assert r["mad"] == pytest.approx(mad)
        assert r["trimmed_mean"] == pytest.approx(trim_mean(v), rel=1e-9), name
        assert r["iqr_outliers"] == ((v < lo) | (v > hi)).sum()
        assert r["mad_outliers"] == ((v < med - 3 * mad) | (v > med + 3 * mad)).sum()
        assert r["whisker_low"] == v[v >= lo].min() and r["whisker_high"] == v[v <= hi].max()


def test_narrowing_terminates_on_infinite_values(spark):
    rows = [("c", float(x)) for x in [-math.inf, *range(200), math.inf]]
    df = spark.createDataFrame(rows, "column string, value double")
    assert os_.quantiles(df, ["column"], {"m": 0.5}, rank_rows=20).first()["m"] == 99.5


def test_normality_and_outliers(spark):
    rng = np.random.default_rng(5)
    normal, skewed = rng.normal(0, 1, 4000), rng.exponential(1, 4000)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(normal, skewed)], "normal double, skewed double")
    out = {r["column"]: r for r in profile.normality(df, ["normal", "skewed"]).collect()}
    assert out["normal"]["is_normal"] and not out["skewed"]["is_normal"]
    bounds = profile.outlier_bounds(df, ["normal", "skewed"])
    assert bounds["normal"] == pytest.approx((normal.mean() - 3 * normal.std(ddof=1), normal.mean() + 3 * normal.std(ddof=1)))
    med = np.median(skewed)
    mad = np.median(np.abs(skewed - med))
    assert bounds["skewed"] == pytest.approx((med - 3 * mad, med + 3 * mad))
    kept = profile.remove_outliers(df, ["normal", "skewed"]).count()
    inside = [(bounds[c][0] <= v) & (v <= bounds[c][1]) for c, v in (("normal", normal), ("skewed", skewed))]
    assert kept == (inside[0] & inside[1]).sum()


def test_k2_of_known_sample(spark):
    """Reference statistic of 0..19 (computed by hand from the published formulas): symmetric and flat."""
    df = spark.createDataFrame([(float(i),) for i in range(20)], "v double")
    r = profile.normality(df, ["v"]).first()
    assert r["skew"] == pytest.approx(0.0, abs=1e-12)
    assert r["kurt"] == pytest.approx(-1.206, abs=1e-3)
    assert 0 < r["p_value"] < 1


def test_binned_counts_drop_the_upper_edge(spark):
    df = spark.createDataFrame([(v,) for v in (0, 9, 10, 20)] + [(None,)], "v int")
    assert {r["bin"]: r["n"] for r in profile.binned_counts(df, "v", 10).collect()} == {"0-9": 2, "10-19": 1}
    wider = df.unionByName(spark.createDataFrame([(21,)], "v int"))
    assert {r["bin"]: r["n"] for r in profile.binned_counts(wider, "v", 10).collect()} == {"0-9": 2, "10-19": 1, "20-29": 2}
    assert profile.binned_counts(df.where("v is null"), "v", 10).count() == 0


def test_histogram_matches_numpy(spark, values):
    wide = values.where("column = 'uniform'").withColumnRenamed("value", "uniform").select("uniform")
    got = [r["n"] for r in profile.histogram(wide, ["uniform"]).orderBy("bin").collect()]
    assert got == np.histogram(CASES["uniform"], bins=30)[0].tolist()


def test_density_integrates_to_about_one(spark):
    v = np.random.default_rng(4).normal(0, 1, 3000)
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    curve = sorted((r["x"], r["density"]) for r in profile.density_curve(df, ["v"]).collect())
    x, y = np.array(curve).T
    assert np.trapezoid(y, x) == pytest.approx(1.0, abs=0.02)


def test_profile_of_awkward_columns(spark):
    df = spark.createDataFrame(
        [(1, " A ", None, True), (2, "a", None, False), (3, "NaN", None, True), (100, "b", None, None)],
        "n int, s string, empty double, flag boolean",
    )
    out = {r["column"]: r for r in profile.profile_table(df).collect()}
    assert [out["s"][c] for c in ("missing", "unique_values", "duplicates", "missing_percent")] == [1, 2, 1, 25.0]
    assert out["s"]["sample_values"] == ["a", "b"] and out["s"]["iqr_outliers"] is None
    assert out["empty"]["missing"] == 4 and out["empty"]["unique_values"] == 0 and out["empty"]["trimmed_mean"] is None
    assert out["n"]["iqr_outliers"] == 1
    assert profile.profile_table(df).first()["column"] == "empty"


def test_correlation_uses_complete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (4.0, 8.0)], "a double, b double")
    got = {(r["x"], r["y"]): r["r"] for r in profile.correlation_matrix(df, ["a", "b"]).collect()}
    assert got["a", "b"] == pytest.approx(1.0) and got["b", "a"] == got["a", "b"] and len(got) == 4
