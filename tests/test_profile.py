import math

import pytest
from conftest import by, rows
from pyspark.sql import functions as F

import gaugeframe as gf

ODD = "Driver's age (yrs)/at.crash"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(
        [(1, 10.0, None, "a", True), (2, None, None, "b", None),
         (3, float("nan"), None, "b", True), (4, 40.0, None, "a", False)],
        f"id bigint, `{ODD}` double, none double, kind string, flag boolean")


def test_roles(spark, odd):
    roles = gf.column_roles(odd, "kind")
    assert roles.numeric == ["id", ODD, "none"]
    assert (roles.categorical, roles.other, roles.target) == ([], ["flag"], "kind")
    assert gf.column_roles(odd, "absent").target is None


def test_dataset_info(odd):
    info = by(gf.dataset_info(odd, "kind"))
    assert info["kind"]["role"] == "target" and info["flag"]["role"] == "other"
    assert info[ODD]["n_rows"] == 4 and info[ODD]["n_columns"] == 5


def test_missing_counts_nan_as_missing(odd):
    got = [(r[0], r[1], r[2]) for r in gf.missing_profile(odd).collect()]
    assert got == [("none", 4, 100.0), (ODD, 2, 50.0), ("flag", 1, 25.0)]


def test_missing_profile_of_an_empty_table(spark):
    assert gf.missing_profile(spark.createDataFrame([], "a int")).count() == 0


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_duplicates_with_nulls_and_nan(spark, limit):
    df = spark.createDataFrame(
        [(1, None), (1, None), (1, float("nan")), (2, 0.0), (2, -0.0), (3, 5.0)],
        "a int, `b c` double")
    assert rows(gf.duplicate_profile(df, limit)) == [(3, 50.0)]
    assert gf.drop_duplicates(df, limit).count() == 3


def test_duplicates_of_an_empty_table(spark):
    assert rows(gf.duplicate_profile(spark.createDataFrame([], "a int"))) == [(0, 0.0)]


def test_numeric_summary_blanks(spark):
    df = spark.range(1, 6).selectExpr("id", "5.0D as k", "if(id = 1, null, id) as gap",
                                      "cast(null as double) as none")
    got = by(gf.numeric_summary(df))
    assert got["id"]["std"] == pytest.approx(math.sqrt(2.5))
    assert (got["id"]["p25"], got["id"]["p50"], got["id"]["p75"]) == (2.0, 3.0, 4.0)
    assert got["id"]["skewness"] == pytest.approx(0)
    assert got["id"]["kurtosis"] == pytest.approx(-1.3)
    assert got["k"]["std"] == 0 and got["k"]["skewness"] is None
    assert got["gap"]["count"] == 4 and got["gap"]["skewness"] is None
    assert got["none"]["count"] == 0 and got["none"]["p50"] is None and got["none"]["min"] is None


def test_row_numbers_have_the_published_shape(spark):
    got = gf.shape_moments(spark.range(1, 60005), ["id"]).first()
    assert got["skewness"] == pytest.approx(0, abs=1e-9)
    assert got["kurtosis"] == pytest.approx(-1.2000000006665779, abs=1e-9)


def test_shape_can_drop_nulls(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (6.0,), (None,)], "x double")
    assert gf.shape_moments(df, ["x"]).first()["skewness"] is None
    assert gf.shape_moments(df, ["x"], "drop").first()["skewness"] == pytest.approx(0.595170064)
    with pytest.raises(ValueError):
        gf.shape_moments(df, ["x"], "keep")


def test_categorical_summary_ties_and_empty_columns(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)],
                               "x string, y string")
    got = by(gf.categorical_summary(df))
    assert got["x"] == {"column_name": "x", "unique_count": 2, "top_category": "a", "top_count": 2}
    assert got["y"] == {"column_name": "y", "unique_count": 0, "top_category": None,
                        "top_count": 0}


def test_target_summary_by_type(spark, odd):
    assert rows(gf.target_summary(odd, "kind")) == [("a", 2), ("b", 2)]
    assert gf.target_summary(odd, "id").first()["mean"] == 2.5


def test_published_class_shares(spark):
    counts = {"Minor": 37990, "PDO": 14228, "Serious": 4445, "Fatal": 1779,
              "property damage only": 660, "Pdo": 422, "P.D.O": 218, "pdo": 120, "POD": 119,
              None: 23}
    df = spark.createDataFrame(list(counts.items()), "kind string, n int").select(
        "kind", F.explode(F.sequence(F.lit(1), "n")).alias("i"))
    got = gf.class_distribution(df, "kind").collect()
    assert [r["class"] for r in got][:3] == ["Minor", "PDO", "Serious"] and len(got) == 9
    assert got[0]["percentage"] == pytest.approx(63.31244583694421)
    ratio = gf.imbalance_ratio(df, "kind").first()
    assert ratio["imbalance_ratio"] == pytest.approx(37990 / 119) and ratio["imbalanced"]


def test_bounds_box_and_nulls(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 100]] + [(None,)], "x double")
    b = gf.iqr_bounds(df, ["x"]).first()
    assert (b["q1"], b["q3"], b["lower_bound"], b["upper_bound"]) == (2.25, 4.75, -1.5, 8.5)
    assert b["outlier_count"] == 1 and b["outlier_percentage"] == pytest.approx(100 / 7)
    box = gf.box_stats(df, ["x"]).first()
    assert (box["whisker_low"], box["whisker_high"], box["median"]) == (1.0, 5.0, 3.5)
    assert box["outlier_count"] == 1


def test_bounds_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert gf.iqr_bounds(df, ["x"]).first()["outlier_count"] == 0
    assert gf.box_stats(df, ["x"]).first()["median"] is None


def test_advice(spark):
    df = spark.range(22).selectExpr(
        "id * 5 as wide", "id as narrow", "cast(id % 11 as string) as eleven",
        "cast(id % 10 as string) as ten", "cast(id % 2 as string) as two", "'x' as one")
    got = by(gf.scaling_advice(df))
    assert got["wide"]["needs_scaling"] and not got["narrow"]["needs_scaling"]
    assert {k: v["advice"] for k, v in by(gf.encoding_advice(df)).items()} == {
        "eleven": "high", "ten": "one-hot", "two": "binary", "one": "one-hot"}


def test_explore_writes_flat_tables(spark, odd, tmp_path):
    tables = gf.explore(odd, "kind")
    gf.write_profile(tables, str(tmp_path))
    back = gf.load_table(spark, f"{tmp_path}/missing_values_report", "csv")
    assert {r["column_name"] for r in back.collect()} == {"none", ODD, "flag"}
    assert "correlation_matrix" in tables and "categorical_summary" not in tables


def test_nothing_to_summarise(spark):
    with pytest.raises(ValueError, match="no columns"):
        gf.scaling_advice(spark.createDataFrame([("a",)], "x string"))
