import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

import gaugeframe as gf
from gaugeframe.operators import encode


def test_binary(spark):
    df = spark.createDataFrame([("no",), ("yes",), (None,)], "x string")
    assert [r["x"] for r in gf.encode_binary(df, ["x"]).collect()] == [0, 1, 2]
    with pytest.raises(ValueError):
        gf.encode_binary(spark.createDataFrame([("no",)], "x string"), ["x"])


def test_onehot_names_order_and_nulls(spark):
    df = spark.createDataFrame(
        [("a b", 1), ("a'c", 2), ("B", 3), (None, 4)], "`k.1` string, n int")
    got = gf.encode_onehot(df, ["k.1"])
    assert got.columns == ["n", "k.1_a b", "k.1_a'c"]
    assert [tuple(r) for r in got.collect()] == [
        (1, True, False), (2, False, True), (3, False, False), (4, False, False)]


def test_values_that_differ_by_case_only(spark):
    df = spark.createDataFrame([("F",), ("MALE",), ("Male",), ("male",)], "sex string")
    got = gf.encode_onehot(df, ["sex"])
    assert got.columns == ["sex_MALE", "sex_Male_2", "sex_male_3"]
    assert [tuple(map(int, r)) for r in got.collect()] == [
        (0, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 1)]
    assert gf.standard_scale(got).columns == got.columns


def test_single_value_leaves_no_indicator(spark):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    assert gf.encode_categoricals(df).columns == ["n"]


def frequency_rows(spark):
    # One value and the nulls hold a third of the rows each.
    return spark.range(900).select("id", F.when(F.col("id") % 3 == 0, "hot").when(
        F.col("id") % 3 == 1, F.concat(F.lit("v"), F.col("id") % 40)).alias("x"))


def test_frequency(spark):
    df = frequency_rows(spark)
    got = {r["id"]: r["x"] for r in gf.encode_frequency(df, ["x"]).collect()}
    assert got[0] == 0.5 and got[2] is None
    counts = {r["x"]: r["count"] for r in df.groupBy("x").count().collect()}
    value = df.where("id = 1").first()["x"]
    assert got[1] == pytest.approx(counts[value] / 600)


def test_frequency_beyond_broadcast(spark, monkeypatch):
    monkeypatch.setattr(encode, "HOT_SHARE", 0.1)
    df = frequency_rows(spark)
    want = rows(gf.encode_frequency(df, ["x"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(gf.encode_frequency(df, ["x"], broadcast_bytes=0)) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_share_moments_equal_those_of_the_coded_column(spark):
    df = frequency_rows(spark).where("x is not null").select("x")
    fit = encode.fit_encoding(df, ["x"])
    coded = encode.apply_encoding(df, fit).agg(F.avg("x"), F.stddev_pop("x")).first()
    assert (fit.shares["x"].mean, fit.shares["x"].std) == pytest.approx(tuple(coded))
    even = spark.range(110).select((F.col("id") % 11).cast("string").alias("x"))
    assert encode.fit_encoding(even, ["x"]).shares["x"].std == 0.0


def test_router_boundary(spark):
    df = spark.range(110).selectExpr(
        "cast(id % 2 as string) as two", "cast(id % 10 as string) as ten",
        "cast(id % 11 as string) as eleven")
    fit = encode.fit_encoding(df, df.columns)
    assert (list(fit.binary), list(fit.one_hot), list(fit.shares)) == (
        ["two"], ["ten"], ["eleven"])
    assert len(gf.encode_categoricals(df).columns) == 1 + 9 + 1


def test_all_null_column(spark):
    df = spark.createDataFrame([(None, 1)], "x string, n int")
    assert gf.encode_categoricals(df).columns == ["n"]
    assert gf.encode_frequency(df, ["x"]).first() == (None, 1)


def test_scale(spark):
    df = spark.createDataFrame([(1.0, 5, True), (3.0, 5, False), (None, 5, True)],
                               "x double, k int, flag boolean")
    got = [tuple(r) for r in gf.standard_scale(df).collect()]
    assert got == [(-1.0, 0.0, True), (1.0, 0.0, False), (None, 0.0, True)]


def test_target(spark):
    df = spark.createDataFrame([("pdo",), ("PDO",), ("P.D.O",), ("Pdo",)], "y string")
    got = {r["y"]: r["label"] for r in gf.encode_target(df, "y").collect()}
    assert got == {"P.D.O": 0, "PDO": 1, "Pdo": 2, "pdo": 3}
    numeric = gf.encode_target(spark.createDataFrame([(7,)], "y int"), "y")
    assert numeric.first()["label"] == 7
    back = gf.decode_label(spark.createDataFrame([(1,), (9,)], "prediction int"), sorted(got))
    assert {r["prediction"]: r["class"] for r in back.collect()} == {1: "PDO", 9: None}


def test_prepare_on_a_small_table(spark):
    df = spark.range(400).selectExpr(
        "id as `row id`", "if(id % 9 = 0, null, id % 50) as `Driver's age`",
        "cast(id % 3 as string) as `kind/of`", "cast(id % 23 as string) as wide",
        "if(id % 2 = 0, 'yes', 'no') as flag", "if(id % 2 = 0, null, 1.0D) as sparse",
        "if(id % 40 = 0, null, if(id % 5 < 2, 'a', 'b')) as y")
    ready = gf.prepare(df.unionByName(df.limit(10)), "y", exclude=["row id"])
    assert ready.features == ["Driver's age", "wide", "flag", "kind/of_1", "kind/of_2"]
    assert ready.classes == ["a", "b"] and ready.missing.dropped == ["sparse"]
    assert ready.df.count() == 400
    sizes = {r["split"]: r["count"] for r in ready.df.groupBy("split").count().collect()}
    assert sizes == {"test": 60, "val": math.ceil(0.15 / 0.85 * 340), "train": 279}
    age = ready.df.agg(F.avg("`Driver's age`"), F.stddev_pop("`Driver's age`")).first()
    assert age[0] == pytest.approx(0, abs=1e-9) and age[1] == pytest.approx(1)


def test_prepare_can_learn_from_training_rows_only(spark):
    df = spark.range(300).selectExpr(
        "id", "if(id % 7 = 0, null, cast(id as double)) as x",
        "cast(id % 60 as string) as k", "if(id % 3 = 0, 'a', 'b') as y")
    ready = gf.prepare(df, "y", fit_on="train", key="id", exclude=["id"])
    train = ready.df.where("split = 'train'").agg(F.avg("x"), F.stddev_pop("x"), F.avg("k")).first()
    assert train[0] == pytest.approx(0, abs=1e-9) and train[1] == pytest.approx(1)
    assert train[2] == pytest.approx(0, abs=1e-9)
    assert ready.df.where("x is null or k is null").count() == 0
    both = {f: sorted((r["id"], r["split"]) for r in gf.prepare(
        df, "y", fit_on=f, key="id", exclude=["id"]).df.collect()) for f in ("all", "train")}
    assert both["all"] == both["train"]


def test_learning_from_training_rows_reads_stored_splits(spark):
    df = spark.range(60).select("id", (F.col("id") % 7).cast("double").alias("x"),
                                F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("y"))
    ready = gf.prepare(df, "y", fit_on="train", key="id", exclude=["id"])
    plan = ready.df._jdf.queryExecution().executedPlan().toString()
    assert "md5(" not in plan and "Join" not in plan
    assert ready.df.groupBy("split").count().count() == 3


def test_prepare_refuses_timestamps(spark):
    df = spark.sql("select 1 as x, 'a' as y, timestamp'2024-01-01' as t")
    with pytest.raises(TypeError, match="neither numbers nor text"):
        gf.prepare(df, "y")
