import numpy as np
import pandas as pd
import pytest
from conftest import by, rows

import gaugeframe as gf


@pytest.fixture(scope="module")
def scored(spark):
    # Class 2 is never predicted, class 3 never true.
    pairs = [(0, 0)] * 4 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 3)] + [(2, 0)] * 2
    return spark.createDataFrame(pairs, "label int, prediction int")


def test_confusion_has_every_cell(scored):
    got = {(r["t"], r["p"]): r["n"] for r in gf.confusion_matrix(scored).collect()}
    assert len(got) == 16 and got[0, 1] == 2 and got[3, 3] == 0 and got[2, 0] == 2


def test_headline_metrics(scored):
    assert gf.accuracy(scored).first()["accuracy"] == pytest.approx(7 / 12)
    w = gf.weighted_prf(scored).first()
    assert w["precision"] == pytest.approx((6 * 4 / 6 + 4 * 3 / 5 + 0) / 12)
    assert w["recall"] == pytest.approx(7 / 12)
    assert w["f1"] == pytest.approx((6 * (2 * 4 / 12) + 4 * (2 * 3 / 9)) / 12)


def test_per_class(spark, scored):
    got = by(gf.per_class_metrics(scored), "class")
    assert got[2] == {"class": 2, "precision": 0, "recall": 0, "f1_score": 0, "support": 2}
    assert got[3]["support"] == 0 and got[0]["recall"] == pytest.approx(4 / 6)
    many = spark.range(11).selectExpr("cast(id as int) as label", "cast(id as int) as prediction")
    assert gf.per_class_metrics(many, max_classes=10).count() == 0
    assert gf.per_class_metrics(many.where("label < 10")).count() == 10


def test_report_rows(scored):
    got = by(gf.classification_report(scored), "name")
    assert set(got) == {"0", "1", "2", "3", "accuracy", "macro avg", "weighted avg"}
    assert got["accuracy"]["f1_score"] == pytest.approx(7 / 12)
    assert got["macro avg"]["recall"] == pytest.approx((4 / 6 + 3 / 4) / 4)


def test_normalised_matrices(scored):
    share = {(r["t"], r["p"]): r["share"] for r in gf.confusion_normalized(scored).collect()}
    assert share[0, 0] == pytest.approx(4 / 6) and share[3, 0] == 0
    error = {(r["t"], r["p"]): r["share"] for r in gf.error_matrix(scored).collect()}
    assert error[0, 1] == 1 and error[0, 0] == 0 and error[2, 0] == 1 and error[3, 1] == 0


def test_top_error_takes_the_lowest_classes_on_ties(scored):
    r = gf.top_error(scored).first()
    assert (r["total"], r["correct"], r["incorrect"]) == (12, 7, 5)
    assert (r["error_true"], r["error_predicted"], r["error_count"]) == (0, 1, 2)
    clean = gf.top_error(scored.where("label = prediction")).first()
    assert clean["error_true"] is None and clean["accuracy"] == 1


def test_distribution_and_bands(scored):
    got = by(gf.prediction_distribution(scored), "outcome")
    assert got["incorrect"]["count"] == 5 and got["correct"]["percentage"] == pytest.approx(700 / 12)
    bands = {r["class"]: r["band"] for r in gf.class_accuracy_band(scored).collect()}
    assert bands == {0: "orange", 1: "green", 2: "red", 3: "red"}


def test_prediction_rows(scored):
    assert gf.prediction_rows(scored).where("correct").count() == 7


def test_probabilities_to_labels(spark):
    df = spark.createDataFrame([(0.5, [0.4, 0.4, 0.2]), (0.51, [0.1, 0.2, 0.7])],
                               "p double, ps array<double>")
    assert [r["prediction"] for r in gf.prob_to_label(df, "p").collect()] == [0, 1]
    assert [r["prediction"] for r in gf.prob_to_label(df, "ps").collect()] == [0, 2]


def test_empty_predictions(spark):
    df = spark.createDataFrame([], "label int, prediction int")
    assert gf.confusion_matrix(df).count() == 0
    assert gf.accuracy(df).first()["accuracy"] is None
    assert gf.weighted_prf(df).first()["f1"] == 0


def test_metrics_per_model(spark):
    df = spark.createDataFrame([("a", 0, 0), ("a", 1, 0), ("b", 1, 1), ("b", 0, 0), ("c", 2, 2)],
                               "model_id string, label int, prediction int")
    got = by(gf.classification_metrics(df, by=["model_id"]), "model_id")
    assert got["a"]["accuracy"] == 0.5 and got["a"]["roc_auc"] == 0.5 and got["a"]["incorrect"] == 1
    assert got["b"]["roc_auc"] == 1.0 and got["c"]["roc_auc"] is None
    assert [m["class"] for m in got["a"]["per_class"]] == [0, 1]


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg))


@pytest.mark.parametrize("rows_per_bucket", [40, 1_000_000])
def test_roc_in_any_number_of_buckets(spark, rows_per_bucket):
    rng = np.random.default_rng(2)
    # A third of the rows share one score.
    s = np.where(rng.random(900) < 0.34, 0.25, rng.random(900).round(2))
    y = (rng.random(900) < s).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"label": y, "score": s}))
    curve = gf.roc_curve(df, rows_per_bucket=rows_per_bucket)
    got = sorted(curve.collect(), key=lambda r: -r["score"])
    for r in got:
        assert r["tp"] == ((s >= r["score"]) & (y == 1)).sum()
        assert r["fp"] == ((s >= r["score"]) & (y == 0)).sum()
    assert got[-1]["tpr"] == 1 and got[-1]["fpr"] == 1 and len(got) == len(set(s))
    assert gf.auc(curve).first()["auc"] == pytest.approx(brute_auc(y, s))


@pytest.mark.parametrize("rows_per_bucket", [50, 1_000_000])
def test_one_against_rest(spark, rows_per_bucket):
    rng = np.random.default_rng(4)
    probs = rng.dirichlet([1, 1, 1], 300).round(2)
    y = rng.integers(0, 2, 300)
    df = spark.createDataFrame(
        [(int(a), [float(v) for v in p]) for a, p in zip(y, probs)],
        "label int, probability array<double>")
    curve = gf.roc_curve_ovr(df, rows_per_bucket=rows_per_bucket)
    got = {r["class"]: r["auc"] for r in gf.auc(curve).collect()}
    for c in (0, 1):
        assert got[c] == pytest.approx(brute_auc((y == c).astype(int), probs[:, c]))
    assert got[2] is None
    assert gf.macro_auc(curve).first()["auc"] == pytest.approx((got[0] + got[1]) / 2)


def test_one_sided_labels_have_no_curve(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.9)], "label int, score double")
    assert gf.auc(gf.roc_curve(df)).first()["auc"] is None
    assert {r["fpr"] for r in gf.roc_curve(df).collect()} == {None}


def test_hard_label_auc(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "label int, prediction int")
    assert rows(gf.auc_from_labels(df)) == [(0.75,)]
