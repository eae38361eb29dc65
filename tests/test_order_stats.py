import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gaugeframe.functions.order_stats import exact_quantiles, sketch_quantiles

PROBS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)


def check(spark, values, countable):
    df = spark.createDataFrame(pd.DataFrame({"x": values})).repartition(5)
    found = exact_quantiles(df, ["x"], PROBS, countable)["x"]
    np.testing.assert_allclose(found, np.quantile(values, PROBS), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("countable", [5, 300, 1_000_000])
@pytest.mark.parametrize("kind", ["normal", "heavy tail", "one value holds a third", "few values"])
def test_matches_numpy_however_often_it_narrows(spark, kind, countable):
    rng = np.random.default_rng(7)
    n = 20_000
    values = {
        "normal": rng.normal(size=n),
        "heavy tail": np.exp(rng.normal(size=n) * 8),
        "one value holds a third": np.where(rng.random(n) < 0.34, 0.0, rng.normal(size=n)),
        "few values": rng.integers(0, 4, n).astype(float),
    }[kind]
    check(spark, values, countable)


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=40))
def test_small_columns(spark, values):
    check(spark, np.array(values) + 0.0, 3)


def test_nulls_nan_and_empty_columns(spark):
    df = spark.createDataFrame(
        [(1.0, None, 2), (float("nan"), None, 4), (3.0, None, None), (None, None, None)],
        "a double, `b.c` double, d int")
    found = exact_quantiles(df, ["a", "b.c", "d"], (0.5,))
    assert found == {"a": [2.0], "b.c": [None], "d": [3.0]}


def test_sketch_is_close(spark):
    df = spark.range(10_001).selectExpr("cast(id as double) as x")
    (median,) = sketch_quantiles(df, ["x"], (0.5,))["x"]
    assert abs(median - 5000) <= 2


def test_text_is_refused(spark):
    with pytest.raises(TypeError, match="not numeric"):
        exact_quantiles(spark.createDataFrame([("a",)], "x string"), ["x"], (0.5,))
