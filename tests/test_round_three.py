"""Radix selection, one-scan statistics, the copy filter, ranges of curves, stored preparations."""

import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

import gaugeframe as gf
from gaugeframe.functions import order_stats
from gaugeframe.functions.columns import column_stats, doubles, unpivoted
from gaugeframe.functions.order_stats import exact_quantiles, image
from gaugeframe.operators import profile
from conftest import by, rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- order-preserving images


def bits(x):
    magnitude = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -magnitude if x < 0 else magnitude


def test_images_are_the_bits_of_doubles(spark):
    rng = np.random.default_rng(1)
    some = rng.integers(0, 2047 << 52, 5_000).view(np.float64).tolist()
    powers = [2.0**k for k in range(-1074, 1024)]
    some += powers + [math.nextafter(x, 0) for x in powers] + [math.nextafter(x, math.inf) for x in powers]
    some = [float(x) for x in [*some, 0.0, math.inf]]
    some += [-x for x in some]
    df = spark.createDataFrame([(x,) for x in some], "x double")
    assert all(r["i"] == bits(r["x"]) for r in df.select("x", image(F.col("x")).alias("i")).collect())


@pytest.mark.parametrize("countable", [1, 50, 10_000])
def test_quantiles_of_odd_values(spark, countable):
    rng = np.random.default_rng(2)
    columns = {
        "infinite": [math.inf] * 30 + [-math.inf] * 20 + [float(k) for k in range(50)],
        "close": (1 + np.arange(100) * 2.0**-52).tolist(),
        "tiny": (np.arange(-50, 50) * 5e-324).tolist(),
        "signs": (rng.standard_normal(100) * 10.0 ** rng.integers(-300, 300, 100)).tolist(),
        "zeros": [0.0, -0.0] * 50,
        "empty": [None] * 100,
    }
    df = spark.createDataFrame(list(zip(*columns.values())),
                               ", ".join(f"{c} double" for c in columns)).repartition(3)
    probs = (0.0, 0.2, 0.25, 0.5, 0.77, 1.0)
    found = exact_quantiles(df, list(columns), probs, countable)
    for c, values in columns.items():
        if c == "empty":
            assert found[c] == [None] * len(probs)
            continue
        s = sorted(values)
        for p, got in zip(probs, found[c]):
            at = p * 99
            low, high = s[math.floor(at)], s[min(math.floor(at) + 1, 99)]
            part = at - math.floor(at)
            want = low if not part or low == high else low + (high - low) * part
            assert got == want or math.isnan(got) and math.isnan(want), (c, p)


def test_images_are_computed_once_per_value_in_code_that_is_compiled(spark):
    # F1, F3 to F6: each part of an image was repeated wherever it occurred, in one huge method.
    names = [f"c{i}" for i in range(54)]
    df = spark.range(10).select(*[(F.col("id") / (i + 1)).alias(c) for i, c in enumerate(names)])
    values = unpivoted(doubles(df, names), [[str(i), c] for i, c in enumerate(names)], ["no", "value"])
    code = values.select("no", image(F.col("value")))._jdf.queryExecution().debug().codegenToSeq()
    stages = [code.apply(i) for i in range(code.size())]
    assert sum(s._2().count("StrictMath.pow(") for s in stages) == 1
    # Java does not compile methods of 8,000 bytes or more.
    assert max(s._3().maxMethodCodeSize() for s in stages) < 8000


def test_later_passes_read_only_columns_with_open_ranks(spark, monkeypatch):
    # every pass unpivoted all columns and computed the images of all values.
    passes = []

    def noted(df, rows, names):
        passes.append(df.columns)
        return unpivoted(df, rows, names)

    monkeypatch.setattr(order_stats, "unpivoted", noted)
    df = spark.range(2_000).selectExpr("5 AS one", "CAST(id % 3 AS DOUBLE) AS few",
                                       "1 + id / 4096D AS many", "CAST(NULL AS INT) AS none")
    found = exact_quantiles(df, df.columns, (0.25, 0.5), countable=10)
    assert found == {"one": [5.0, 5.0], "few": [0.0, 1.0], "none": [None, None],
                     "many": [1 + 499.75 / 4096, 1 + 999.5 / 4096]}
    assert passes[0] == ["one", "few", "many", "none"] and len(passes) > 1
    assert all(columns == ["many"] for columns in passes[1:])


def test_quantiles_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a double, b int")
    assert exact_quantiles(df, ["a", "b"], (0.5,)) == {"a": [None], "b": [None]}


# --- one scan


def test_statistics_of_54_csv_columns_take_one_scan(spark, tmp_path):
    names = [f"c{i}" for i in range(54)]
    df = spark.range(50).select(*[(F.col("id") * i).cast("double").alias(c) for i, c in enumerate(names)])
    df.write.option("header", True).csv(str(tmp_path / "t"))
    schema = ", ".join(f"{c} double" for c in names)
    csv = spark.read.schema(schema).option("header", True).csv(str(tmp_path / "t"))
    for out in (gf.missing_profile(csv), profile.missing_counts(csv), gf.shape_moments(csv),
                gf.scaling_advice(csv), column_stats(csv, names, {"n": "count(value)"})):
        assert plan(out).count("FileScan csv") == 1
    assert by(gf.scaling_advice(csv))["c3"]["range"] == 147.0


def test_statistics_without_rows(spark):
    df = spark.createDataFrame([], "a double, b int, `odd name` double")
    assert by(gf.numeric_summary(df))["odd name"]["count"] == 0
    assert by(gf.iqr_bounds(df))["a"]["outlier_count"] == 0
    assert {r["needs_scaling"] for r in gf.scaling_advice(df).collect()} == {False}
    assert gf.missing_profile(df).count() == 0 and gf.histogram(df).count() == 0
    assert by(gf.box_stats(df))["b"]["outlier_count"] == 0


def test_histogram_beside_infinite_values(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 1.0, 2.0, 4.0, math.inf, -math.inf, math.inf, None)],
                               "x double")
    got = {r["bin"]: (r["bin_start"], r["bin_end"], r["count"]) for r in gf.histogram(df, bins=4).collect()}
    assert got == {0: (-math.inf, 0.0, 1), 1: (0.0, 1.0, 1), 2: (1.0, 2.0, 1), 3: (2.0, 3.0, 1),
                   4: (3.0, 4.0, 1), 5: (4.0, math.inf, 2)}
    only = spark.createDataFrame([(math.inf,)], "x double")
    assert [r["count"] for r in gf.histogram(only).collect()] == [1]


# --- copies


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_copies_with_and_without_the_filter(spark, limit):
    df = spark.range(3_000).select((F.col("id") % 2_500).alias("a"), F.lit(None).cast("string").alias("b"),
                                   F.when(F.col("id") % 3 == 0, F.lit("x")).alias("c"))
    want = df.distinct().count()
    assert gf.drop_duplicates(df, suspect_limit=limit).count() == want
    assert gf.duplicate_profile(df, suspect_limit=limit).head()["duplicate_count"] == 3_000 - want
    assert rows(gf.drop_duplicates(df, suspect_limit=limit)) == rows(df.distinct())


def test_rows_without_copies_are_not_moved(spark):
    df = spark.range(5_000).select((F.col("id") % 4_000).alias("a"))
    alone, copied = profile.split_by_copies(df, suspect_limit=0)
    # Only the filter is exchanged, by broadcast.
    assert all("hashpartitioning" not in plan(t) and "SortMergeJoin" not in plan(t)
               for t in (alone, copied))
    assert alone.count() + copied.count() == 5_000 and 2_000 <= copied.count() < 2_400


# --- curves


def test_curves_in_ranges_hold_many_equal_scores(spark):
    df = spark.range(4_000).select(
        F.when(F.col("id") % 2 == 0, 0.5).otherwise(F.col("id") / 4_000).alias("score"),
        (F.col("id") % 3 == 0).cast("int").alias("label"))
    assert rows(gf.roc_curve(df, rows_per_bucket=100)) == rows(gf.roc_curve(df))


# --- stored preparations


def _table(spark, n=600):
    return spark.range(n).select(
        "id", F.when(F.col("id") % 2 == 0, F.lit("a")).otherwise("b").alias("kind"),
        F.when(F.col("id") % 10 < 9, None).otherwise("x").alias("gone"),
        F.when(F.col("id") % 50 == 7, None).otherwise(F.pow(F.col("id"), F.lit(1.5))).alias("size"),
        F.when(F.col("id") % 3 == 0, F.lit("p")).otherwise("q").alias("side"),
        F.concat(F.lit("m"), (F.col("id") % 5).cast("string")).alias("Make"),
        F.concat(F.lit("t"), (F.col("id") % 37).cast("string")).alias("town"),
        (F.col("id") % 4 == 0).alias("flag"))


@pytest.mark.parametrize("fit_on", ["all", "train"])
def test_stored_preparation_gives_the_prepared_rows(spark, tmp_path, fit_on):
    df = _table(spark)
    ready = gf.prepare(df, "kind", fit_on=fit_on, key="id", exclude=["id"])
    gf.save_preparation(ready, str(tmp_path / "p"))
    learned = gf.load_preparation(spark, str(tmp_path / "p"))
    want = ready.df.drop("split", "__gf_row")
    for out in (gf.transform(df, learned), gf.transform(df, ready)):
        assert out.columns[:len(ready.features)] == ready.features
        assert rows(out.select(*want.columns)) == rows(want)


def test_new_rows_unseen_values_and_missing_columns(spark, tmp_path):
    ready = gf.prepare(_table(spark), "kind", key="id", exclude=["id"])
    gf.save_preparation(ready, str(tmp_path / "p"))
    learned = gf.load_preparation(spark, str(tmp_path / "p"))
    new = _table(spark, 3).drop("kind", "gone").withColumns({
        "side": F.lit("other"), "Make": F.lit("m99"), "town": F.lit("nowhere"), "make_m1": F.lit("z")})
    out = gf.transform(new, learned).collect()
    assert len(out) == 3 and "label" not in out[0].asDict()
    assert all(not r["Make_m1"] and r["town"] is None for r in out)
    assert gf.transform(new.limit(0), learned).count() == 0
    with pytest.raises(ValueError, match="size"):
        gf.transform(new.drop("size"), learned)


def test_another_version_is_refused(spark, tmp_path):
    ready = gf.prepare(_table(spark), "kind", key="id", exclude=["id"])
    path = str(tmp_path / "p")
    gf.save_preparation(ready, path)
    stored = spark.read.parquet(f"{path}/parameters").withColumn(
        "amount", F.when(F.col("step") == "version", 99.0).otherwise(F.col("amount")))
    stored.write.parquet(f"{path}2/parameters")
    spark.read.parquet(f"{path}/shares").write.parquet(f"{path}2/shares")
    with pytest.raises(ValueError, match="version"):
        gf.load_preparation(spark, f"{path}2")


# --- densities, cells


def test_binned_density_is_close_to_the_exact_one(spark):
    df = spark.range(4_000).select((F.sqrt("id") % 7).alias("x"), F.lit(3.0).alias("flat"),
                                   F.when(F.col("id") > 10, F.lit(None)).otherwise(F.col("id")).cast("double").alias("few"))
    got = gf.density_columns(df).collect()
    assert {r["column_name"] for r in got} == {"x", "few"}
    for c in ("x", "few"):
        exact = [r["density"] for r in gf.density(df, c).orderBy("point").collect()]
        found = [r["density"] for r in sorted(got, key=lambda r: r["point"]) if r["column_name"] == c]
        assert max(abs(a - b) for a, b in zip(exact, found)) < 0.004 * max(exact)


def test_density_far_from_most_values(spark):
    df = spark.range(2_000).select(F.when(F.col("id") == 0, 1e9).otherwise(F.col("id") % 5).alias("x"))
    found = [r["density"] for r in gf.density_columns(df).orderBy("point").collect()]
    exact = [r["density"] for r in gf.density(df, "x").orderBy("point").collect()]
    assert max(abs(a - b) for a, b in zip(exact, found)) < 0.004 * max(exact)


def test_sparse_cells_of_many_classes(spark):
    df = spark.range(3_000).select(F.col("id").alias("label"), (F.col("id") + F.col("id") % 2).alias("prediction"))
    assert gf.confusion_matrix(df, sparse=True).count() == 3_000
    wrong = gf.error_matrix(df, sparse=True).collect()
    assert len(wrong) == 1_500 and {r["share"] for r in wrong} == {1.0}
    assert {r["share"] for r in gf.confusion_normalized(df, sparse=True).collect()} == {1.0}


# --- training that stops early and goes on


def _points(spark):
    return spark.range(400).select(
        (F.col("id") % 2).cast("int").alias("label"), F.sin("id").alias("a"),
        (F.cos("id") + F.col("id") % 2).alias("b"),
        F.when(F.col("id") % 4 == 3, "val").otherwise("train").alias("split"))


def test_a_stopped_training_goes_on_where_it_was(spark, tmp_path):
    df = _points(spark)
    train, val = df.where("split = 'train'"), df.where("split = 'val'")
    options = {"features": ["a", "b"], "hidden": (4,), "iterations": 3, "patience": 2, "seed": 5}
    _, whole = gf.fit_early_stopping(train, val, rounds=4, **options)
    state = str(tmp_path / "state")
    _, first = gf.fit_early_stopping(train, val, rounds=2, state=state, **options)
    model, resumed = gf.fit_early_stopping(train, val, rounds=4, state=state, **options)
    assert first.count() == 2
    assert [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in whole.collect()] == \
        [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in resumed.collect()]
    again, same = gf.fit_early_stopping(train, val, rounds=4, state=state, **options)
    assert same.count() == resumed.count()
    pick = lambda m: [r["probability"] for r in gf.predict(m, val).collect()]
    assert pick(again) == pick(model)
    with pytest.raises(ValueError, match="other settings"):
        gf.fit_early_stopping(train, val, rounds=4, state=state, **{**options, "seed": 6})


def test_training_of_a_prepared_table_returns_its_history(spark):
    ready = gf.prepare(_table(spark), "kind", key="id", exclude=["id"])
    out = gf.train_with_stopping(ready, hidden=(3,), rounds=2, iterations=2, model_id="m")
    assert out.scored.count() == ready.df.where("split = 'test'").count()
    assert out.history.columns[0] == "run_id" and {r["run_id"] for r in out.history.collect()} == {"m"}
    assert gf.training_summary(out.history).head()["total_epochs"] == out.history.count()


def test_results_tree_of_models_without_history(spark):
    preds = spark.range(40).select(
        F.when(F.col("id") < 20, "a").otherwise("b").alias("model_id"),
        (F.col("id") % 3).cast("int").alias("label"), (F.col("id") % 2).cast("int").alias("prediction"))
    tests = gf.classification_metrics(preds, by=["model_id"])
    cells = gf.outcome_counts(preds, by=["model_id"])
    folds = spark.createDataFrame(
        [("a", k, 0.9, 0.9, 0.9, 0.9) for k in (1, 0)], "model_id string, fold int, accuracy double,"
        " precision double, recall double, f1 double")
    history = spark.createDataFrame(
        [("a", 2, 0.2, 0.2, 0.2, 0.2), ("a", 1, 0.3, 0.3, 0.1, 0.1)], "run_id string, epoch int,"
        " loss double, val_loss double, accuracy double, val_accuracy double")
    missing = spark.createDataFrame([(7, 0)], "missing_before long, missing_after long")
    tree = gf.results_tree(tests, cells, folds, history, missing=missing, settings={"k": 2})
    out = {r["model_id"]: r for r in tree.collect()}
    assert set(out) == {"a", "b"} and out["b"]["preparation"]["missing_before"] == 7
    assert out["b"]["preparation"]["settings"] == {"k": "2"}
    assert sum(c["n"] for c in out["a"]["test"]["cells"]) == 20
    assert [r["epoch"] for r in out["a"]["training"]["rounds"]] == [1, 2]
    assert [r["fold"] for r in out["a"]["cross_validation"]["folds"]] == [0, 1]
    assert out["b"]["training"]["rounds"] is None and out["b"]["cross_validation"]["folds"] is None
    card = gf.scorecard(tests, gf.cv_summary(folds), missing=missing).head()
    assert (card["missing_before"], card["missing_after"]) == (7, 0)


# --- many classes


def test_classes_beyond_any_list(spark):
    df = spark.range(260_000).select(
        "id", F.when(F.col("id") >= 210_000, F.lit("hot")).when(F.col("id") >= 200_000, None).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 150_000).cast("string"))).alias("kind"))
    known = gf.class_dictionary(df, "kind", rows_per_range=20_000)
    names = sorted([f"k{i}" for i in range(150_000)] + ["hot"])
    coded = gf.encode_target(df, "kind", dictionary=known)
    assert coded.columns == ["id", "kind", "label"] and coded.count() == 260_000
    found = coded.where("id % 1009 = 0").collect()
    assert all(r["label"] is None if r["kind"] is None else names[r["label"]] == r["kind"] for r in found)
    back = gf.decode_label(coded, known, "label", "name")
    assert back.where("NOT (name <=> kind)").count() == 0
    with pytest.raises(ValueError, match="class_dictionary"):
        gf.encode_target(df, "kind")
    odd = gf.encode_target(spark.createDataFrame([("other",), (None,)], "kind string"), "kind", dictionary=known)
    assert [r["label"] for r in odd.collect()] == [None, None]


def test_dictionary_of_an_empty_table(spark):
    df = spark.createDataFrame([], "kind string")
    known = gf.class_dictionary(df, "kind")
    assert known.count() == 0 and gf.encode_target(df, "kind", dictionary=known).count() == 0
