import numpy as np
import pandas as pd
import pytest

import gaugeframe as gf
from gaugeframe.operators import distribution


@pytest.mark.parametrize("direct", [0, 45])
def test_pairwise_complete_correlation(spark, monkeypatch, direct):
    monkeypatch.setattr(distribution, "DIRECT_PAIRS", direct)
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.normal(size=(300, 4)), columns=["a", "b", "c.d", "e"])
    pdf["b"] += pdf["a"]
    pdf.loc[rng.random(300) < 0.3, "b"] = np.nan
    pdf.loc[rng.random(300) < 0.2, "c.d"] = np.nan
    pdf["k"], pdf["none"] = 5.0, np.nan
    want = pdf.corr()
    got = gf.correlation_matrix(spark.createDataFrame(pdf)).collect()
    assert len(got) == 36
    for r in got:
        w = want.loc[r["a"], r["b"]]
        if np.isnan(w):
            assert r["corr"] is None
        else:
            assert r["corr"] == pytest.approx(w, abs=1e-12)


def test_perfect_pairs(spark):
    df = spark.range(1, 50).selectExpr("id as a", "id * 0.1 + 3 as b", "-id * 0.7 as c")
    corr = gf.correlation_matrix(df)
    found = {(r["a"], r["b"]): r["corr"] for r in corr.collect()}
    assert found["a", "b"] == 1.0 and found["a", "c"] == -1.0
    top = [(r["a"], r["b"]) for r in gf.top_correlations(corr).collect()]
    assert top == [("a", "c"), ("b", "c"), ("c", "a"), ("c", "b")]
    assert len(gf.top_correlations(corr, symmetric=False).collect()) == 2
    triangle = [(r["a"], r["b"]) for r in gf.correlation_lower_triangle(corr).collect()]
    assert sorted(triangle) == [("b", "a"), ("c", "a"), ("c", "b")]


@pytest.mark.parametrize("direct", [0, 45])
def test_common_rows_that_hardly_vary(spark, monkeypatch, direct):
    monkeypatch.setattr(distribution, "DIRECT_PAIRS", direct)
    # b is nearly constant where a is present, and constant where c is.
    df = spark.createDataFrame(
        [(1.0, 1e6, 1.0), (2.0, 1e6 + 1e-3, None), (4.0, 1e6, 2.0), (None, -1e6, None),
         (None, -2e6, None)], "a double, b double, c double")
    want = df.toPandas().corr()
    found = {(r["a"], r["b"]): r["corr"] for r in gf.correlation_matrix(df).collect()}
    assert found["a", "b"] == pytest.approx(want.loc["a", "b"], rel=1e-6)
    assert found["b", "c"] is None


def test_many_columns(spark):
    df = spark.range(40).selectExpr(*[f"sin(id * {i + 1}) as c{i}" for i in range(25)])
    want = df.toPandas().corr()
    got = gf.correlation_matrix(df).collect()
    assert len(got) == 625
    assert all(r["corr"] == pytest.approx(want.loc[r["a"], r["b"]]) for r in got)


def test_histogram_matches_numpy(spark):
    values = np.random.default_rng(5).normal(size=500)
    got = gf.histogram(spark.createDataFrame(pd.DataFrame({"x y": values})), ["x y"], 7)
    counts, edges = np.histogram(values, 7)
    rows = sorted(got.collect(), key=lambda r: r["bin"])
    assert [r["count"] for r in rows] == counts.tolist()
    np.testing.assert_allclose([r["bin_start"] for r in rows], edges[:-1])


def test_histogram_of_constant_and_empty(spark):
    df = spark.createDataFrame([(5.0, None), (5.0, None), (None, None)], "k double, none double")
    rows = gf.histogram(df, ["k", "none"]).collect()
    assert len(rows) == 30 and sum(r["count"] for r in rows) == 2
    assert next(r["bin"] for r in rows if r["count"]) == 16
    assert gf.histogram(df, ["none"]).count() == 0


@pytest.mark.parametrize("far", [3.0, 1e5])
def test_density_matches_direct_sum(spark, far):
    # With a far value most grid points are out of every kernel's reach.
    x = np.append(np.random.default_rng(1).normal(size=20000).round(2), [far] * 2)
    got = gf.density(spark.createDataFrame(pd.DataFrame({"x": x})), "x", points=25)
    rows = sorted(got.collect(), key=lambda r: r["point"])
    width = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min() - 3 * width, x.max() + 3 * width, 25)
    want = np.exp(-0.5 * ((grid[:, None] - x) / width) ** 2).sum(1) / (
        len(x) * width * np.sqrt(2 * np.pi))
    np.testing.assert_allclose([r["x"] for r in rows], grid)
    np.testing.assert_allclose([r["density"] for r in rows], want, rtol=1e-9, atol=1e-300)
    assert gf.density(spark.createDataFrame([(1.0,), (1.0,)], "x double"), "x").count() == 0
