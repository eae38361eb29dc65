import pytest
from conftest import rows
from pyspark.sql import functions as F

import gaugeframe as gf
from gaugeframe.functions.columns import canonical


def test_exactly_thirty_percent_is_kept(spark):
    df = spark.range(1000).selectExpr(
        "id", "if(id < 300, null, id) as kept", "if(id < 301, null, id) as gone",
        "if(id < 999, null, 'x') as `the.target`")
    assert gf.drop_sparse_columns(df, protect=["the.target"]).columns == ["id", "kept", "the.target"]


def test_median_of_integers_may_be_half(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert rows(gf.impute_median(df, ["x"])) == [(1.0,), (1.5,), (2.0,)]


def test_mode_ties_empty_text_and_other_types(spark):
    df = spark.createDataFrame(
        [("b", None, True, "it's"), ("a", None, None, "it's"), (None, None, True, None),
         ("b", None, False, "a\\b"), ("a", None, None, None)],
        "x string, none string, flag boolean, quoted string")
    got = gf.impute_mode(df, ["x", "none", "flag", "quoted"]).collect()
    assert got[2] == ("a", "Unknown", True, "it's")
    assert got[1]["flag"] is True


def test_clean_missing_fills_the_target(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), (None, 3.0), ("b", 4.0)],
                               "y string, x double")
    assert rows(gf.clean_missing(df, "y")) == [("a", 1.0), ("a", 3.0), ("a", 3.0), ("b", 4.0)]
    kept = gf.clean_missing(df, "y", impute_target=False)
    assert kept.where("y is null").count() == 1


def test_missing_totals(spark):
    df = spark.createDataFrame([("a", None), (None, 2.0), ("a", 3.0), ("b", 4.0)],
                               "y string, x double")
    assert gf.missing_totals(df, gf.clean_missing(df, "y")).first() == (2, 0)


def test_caps_keep_nulls(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 100]] + [(None,)], "x double")
    got = rows(gf.cap_outliers(df, ["x"]))
    assert (8.5,) in got and (None,) in got and (100.0,) not in got


def test_zero_iqr_flattens_unless_skipped(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(3,)], "x int")
    assert set(rows(gf.cap_outliers(df, ["x"]))) == {(0.0,)}
    assert (3,) in rows(gf.cap_outliers(df, ["x"], skip_zero_iqr=True))


def test_coerce_numeric(spark):
    df = spark.createDataFrame([(" 2 ", None, 1), ("x", 2.5, None), (None, None, 3), ("NaN", 1.0, 4)],
                               "s string, d double, i int")
    assert [tuple(r) for r in gf.coerce_numeric(df).collect()] == [
        (2.0, 0.0, 1), (0.0, 2.5, 0), (0.0, 0.0, 3), (0.0, 1.0, 4)]


def test_canonical_types(spark):
    df = spark.sql("select cast(1.5 as decimal(5,2)) as d, double('NaN') as n, 'a' as s")
    assert canonical(df).dtypes == [("d", "double"), ("n", "double"), ("s", "string")]
    assert canonical(df).first() == (1.5, None, "a")


def test_duplicates_pass_through_without_a_shuffle(spark):
    # A third of all rows are copies of one row.
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("a"))
    got = gf.drop_duplicates(df)
    assert got.count() == 2001
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_duplicates_keep_every_distinct_row(spark, limit):
    df = spark.range(50).selectExpr("id % 20 as a", "cast(id % 4 as string) as `b c`")
    assert rows(gf.drop_duplicates(df, limit)) == rows(df.distinct())
