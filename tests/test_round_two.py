"""Faults of earlier versions: caps, ids that were fitted, unseen values, lost microseconds."""

import math

from pyspark.sql import functions as F

import gaugeframe as gf
from gaugeframe.operators.metrics import classification_metrics


def test_many_classes_are_all_listed(spark):
    df = spark.range(330).select((F.col("id") % 11).alias("label"), (F.col("id") % 11).alias("prediction"))
    assert gf.per_class_metrics(df).count() == 11
    assert gf.per_class_metrics(df, max_classes=10).count() == 0
    assert len(classification_metrics(df).head()["per_class"]) == 11
    assert classification_metrics(df, max_classes=10).head()["per_class"] is None


def test_rows_that_differ_in_microseconds_have_their_own_key(spark):
    df = spark.range(1_000).select(F.timestamp_micros("id").alias("at"), (F.col("id") % 2).alias("label"))
    parts = {r["split"]: r["count"] for r in gf.stratified_split(df, "label").groupBy("split").count().collect()}
    assert parts == {"train": 700, "val": 150, "test": 150}


def test_median_beside_infinity(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (math.inf,)], "x double")
    assert gf.box_stats(df, ["x"]).head()["median"] == 2.0


def _table(spark):
    return spark.range(400).select(
        "id", F.when(F.col("id") % 2 == 0, F.lit("a")).otherwise("b").alias("kind"),
        F.when(F.col("id") % 10 < 9, None).otherwise("x").alias("note"),
        F.when(F.col("id") == 5, None).otherwise(F.col("id") * 1.5).alias("size"),
        F.when(F.col("id") % 3 == 0, F.lit("p")).otherwise("q").alias("side"))


def test_excluded_columns_pass_untouched(spark):
    for fit_on in ("all", "train"):
        out = gf.prepare(_table(spark), "kind", fit_on=fit_on, key="id", exclude=["id", "note"]).df
        assert out.where("note IS NULL").count() == 360 and out.select("id").distinct().count() == 400


def test_values_not_seen_in_training_have_a_code(spark):
    df = _table(spark)
    plain = gf.prepare(df, "kind", fit_on="train", key="id", exclude=["id", "note"]).df
    held = [r["id"] for r in plain.where("split = 'test'").select("id").take(3)]
    odd = df.withColumn("side", F.when(F.col("id").isin(held), F.lit("r")).otherwise(F.col("side")))
    out = gf.prepare(odd, "kind", fit_on="train", key="id", exclude=["id", "note"]).df
    assert out.where("side IS NULL").count() == 0
    assert out.where(F.col("id").isin(held)).select("side").distinct().count() == 1


def test_one_column_table_with_a_hot_value_is_not_skewed(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(
        F.col("id").cast("string")).alias("v"))
    out = gf.encode_frequency(df, ["v"], broadcast_bytes=0)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    assert out.where("v = 0.5").count() == 20_000
