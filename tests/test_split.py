import hashlib

import pytest
from pyspark.sql import functions as F

from gaugeframe.functions import hashrank
from gaugeframe.operators.split import (
    class_quotas,
    kfold_assign,
    split_quotas,
    split_report,
    stratified_split,
    train_full,
)

# Class counts of a published table: 38,013 after imputing 23 missing labels with "Minor".
COUNTS = {"Fatal": 1779, "Minor": 38013, "P.D.O": 218, "PDO": 14228, "POD": 119, "Pdo": 422,
         "Serious": 4445, "pdo": 120, "property damage only": 660}


def test_published_test_counts():
    tests, vals = split_quotas(COUNTS, 0.15, 0.15)
    assert [tests[c] for c in sorted(COUNTS)] == [267, 5702, 33, 2134, 18, 63, 667, 18, 99]
    assert sum(tests.values()) == 9001
    assert sum(vals.values()) == 9001


def test_quota_ties_go_to_the_first_class():
    assert class_quotas({"a": 5, "b": 5}, 3) == {"a": 2, "b": 1}


def expected(ids, label, test=0.15, val=0.15, seed=42):
    groups = {}
    for i in ids:
        groups.setdefault("=" + str(label(i)), []).append(
            (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))
    tests, vals = split_quotas({g: len(v) for g, v in groups.items()}, test, val)
    out = {}
    for g, members in groups.items():
        for rank, (_, i) in enumerate(sorted(members)):
            out[i] = ("test" if rank < tests[g] else
                      "val" if rank < tests[g] + vals[g] else "train")
    return out


@pytest.mark.parametrize("rankable", [3, 100, 1_000_000])
def test_split_equals_brute_force(spark, rankable):
    # Class 0 holds a third of all rows or more.
    df = spark.range(3000).withColumn(
        "y", F.when(F.col("id") % 3 == 0, 0).otherwise((F.col("id") % 7).cast("int")))
    got = stratified_split(df.repartition(6), "y", key="id", rankable_rows=rankable)
    want = expected(range(3000), lambda i: 0 if i % 3 == 0 else i % 7)
    assert {r["id"]: r["split"] for r in got.collect()} == want


def test_split_does_not_shuffle_rows(spark):
    df = spark.range(1000).withColumn("y", F.col("id") % 2)
    plan = stratified_split(df, "y", key="id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan


def test_search_of_cutoffs_hashes_a_row_once(spark):
    df = spark.range(10).union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    keys = df.select(hashrank.row_key(df, 42, "id").alias(hashrank.KEY), F.lit("=a").alias(hashrank.GROUP))
    every = spark.createDataFrame([("=a", 0, "", 1, 10)], hashrank._STATE)
    inside = hashrank._inside(keys, every, 0)
    assert inside._jdf.queryExecution().executedPlan().toString().count("md5(") == 1
    # A row without a key is in no prefix.
    assert inside.count() == 10 and inside.where(F.col(hashrank.KEY).isNull()).count() == 0


def test_one_class_and_tiny_class(spark):
    one = stratified_split(spark.range(20).withColumn("y", F.lit("a")), "y", key="id")
    assert {r["split"]: r["n"] for r in one.groupBy("split").agg(F.count("*").alias("n")).collect()
            } == {"test": 3, "val": 3, "train": 14}
    rare = spark.range(100).withColumn("y", F.when(F.col("id") == 5, "b").otherwise("a"))
    assert stratified_split(rare, "y", key="id").where("y = 'b'").first()["split"] == "train"


def test_missing_labels_are_their_own_stratum(spark):
    df = spark.range(40).withColumn("y", F.when(F.col("id") < 20, "a"))
    got = stratified_split(df, "y", key="id").where("y is null and split = 'test'").count()
    assert got == 3


def test_whole_row_key_needs_distinct_rows(spark):
    df = spark.range(50).select(F.lit("x").alias("y"))
    with pytest.raises(ValueError, match="unique key"):
        stratified_split(df, "y")


def test_empty_table(spark):
    assert stratified_split(spark.createDataFrame([], "id int, y string"), "y").count() == 0


def test_report_and_train_full(spark):
    df = stratified_split(spark.range(200).withColumn("y", F.col("id") % 2), "y", key="id")
    report = {(r["split"], r["class"]): r for r in split_report(df, "y").collect()}
    assert report["test", 0]["n"] == 15 and report["test", 0]["split_size"] == 30
    assert report["train", 1]["class_percentage"] == pytest.approx(100 * 70 / 139)
    assert report["test", 1]["split_percentage"] == pytest.approx(15)
    assert report["val", 0]["split_size"] == 31
    assert train_full(df).count() == 170


@pytest.mark.parametrize("rankable", [4, 1_000_000])
def test_folds(spark, rankable):
    got = kfold_assign(spark.range(503), 5, key="id", rankable_rows=rankable)
    order = sorted(range(503), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    ends = [101, 202, 303, 403]
    want = {i: sum(rank >= e for e in ends) for rank, i in enumerate(order)}
    assert {r["id"]: r["fold"] for r in got.collect()} == want


def test_too_few_rows_for_folds(spark):
    with pytest.raises(ValueError, match="folds"):
        kfold_assign(spark.range(3), 5, key="id")
