import pytest
from conftest import by

import gaugeframe as gf
from gaugeframe.operators import verdict


@pytest.fixture(scope="module")
def history(spark):
    rows = [("a", 1, 0.9, 0.8, 0.5, 0.6, 0.001), ("a", 2, 0.5, 0.4, 0.7, 0.8, 0.001),
            ("a", 3, 0.4, 0.4, 0.8, 0.8, 0.0005), ("b", 1, 0.3, 0.5, 0.9, 0.7, 0.001)]
    return spark.createDataFrame(
        rows, "run_id string, epoch int, loss double, val_loss double, accuracy double,"
              " val_accuracy double, lr double")


def test_summary_takes_the_earliest_epoch_on_ties(history):
    got = by(gf.training_summary(history, max_epochs=3), "run_id")
    a = got["a"]
    assert (a["best_epoch_by_val_loss"], a["best_epoch_by_val_accuracy"]) == (2, 2)
    assert (a["final_training_loss"], a["best_validation_accuracy"]) == (0.4, 0.8)
    assert a["loss_gap"] == pytest.approx(0) and a["accuracy_gap"] == pytest.approx(0)
    assert not a["early_stopping_triggered"] and a["lr_reduced"]
    assert (a["initial_lr"], a["final_lr"]) == (0.001, 0.0005)
    assert got["b"]["early_stopping_triggered"] and not got["b"]["lr_reduced"]


def test_summary_without_rates(history):
    assert "lr_reduced" not in gf.training_summary(history.drop("lr")).columns


def test_gap_sides(history):
    sides = [r["larger"] for r in gf.loss_gap(history).orderBy("run_id", "epoch").collect()]
    assert sides == ["train > val", "train > val", "equal", "val > train"]


def test_cv_summary_uses_the_population_std(spark):
    df = spark.createDataFrame([("m", 0.8, 0.1, 0.1, 0.1), ("m", 0.9, 0.1, 0.1, 0.3)],
                               "model_id string, accuracy double, precision double, recall double,"
                               " f1 double")
    r = gf.cv_summary(df).first()
    assert r["std_accuracy"] == pytest.approx(0.05) and r["n_folds"] == 2
    assert (r["min_f1"], r["max_f1"], r["mean_f1"]) == pytest.approx((0.1, 0.3, 0.2))


SCHEMA = ("model_id string, accuracy double, f1_weighted double, roc_auc double,"
          " per_class array<struct<f1_score: double, support: bigint>>, correct bigint,"
          " incorrect bigint, std_accuracy double, precision_weighted double,"
          " recall_weighted double")


@pytest.fixture(scope="module")
def models(spark):
    return spark.createDataFrame([
        ("best", 0.95, 0.95, 0.9, [(0.9, 50), (0.8, 40)], 95, 5, 0.01, 0.9, 0.9),
        ("fair", 0.8, 0.7, None, [(0.9, 50), (0.6, 4)], 80, 20, 0.07, 0.9, 0.9),
        ("poor", 0.5, 0.4, 0.4, [(0.4, 5), (0.6, 0)], 50, 50, 0.2, 0.9, 0.9),
        ("blank", None, None, None, None, None, None, None, None, None),
    ], SCHEMA)


def column(df, name):
    return {r["model_id"]: r[name] for r in df.collect()}


def test_strengths(models):
    got = column(gf.strengths(models), "strengths")
    assert got["best"] == [verdict.HIGH_ACCURACY, verdict.BALANCED_F1, verdict.EVEN_CLASSES,
                           verdict.HIGH_AUC]
    assert got["fair"] == [verdict.GOOD_ACCURACY]
    assert got["poor"] == got["blank"] == [verdict.BASELINE]
    report = column(gf.strengths(models, "report"), "strengths")
    assert report["best"] == [verdict.HIGH_ACCURACY, verdict.BALANCED_F1]
    assert report["poor"] == [verdict.BASELINE]


def test_weaknesses(models):
    got = column(gf.weaknesses(models), "weaknesses")
    assert got["best"] == []
    assert got["fair"] == [verdict.UNEVEN_SUPPORT, verdict.LOW_AUC]
    assert got["poor"] == [verdict.LOW_ACCURACY, verdict.POOR_F1, verdict.POOR_CLASSES,
                           verdict.UNEVEN_SUPPORT, verdict.LOW_AUC]
    report = column(gf.weaknesses(models, "report"), "weaknesses")
    assert report["poor"] == [verdict.LOW_ACCURACY, verdict.POOR_F1, verdict.VARIABLE_FOLDS]


def test_recommendations(models):
    got = column(gf.recommendations(models), "recommendations")
    assert got["best"] == verdict.GENERAL
    assert got["fair"] == [verdict.FOR_F1, *verdict.GENERAL]
    assert got["poor"] == [*verdict.FOR_ACCURACY, verdict.FOR_F1, *verdict.FOR_FOLDS,
                           verdict.FOR_ERRORS, *verdict.GENERAL]
    assert got["blank"] == [*verdict.FOR_ACCURACY, *verdict.GENERAL]


def test_bands_and_grades(models):
    assert column(gf.stability_band(models), "stability") == {
        "best": "High", "fair": "Medium", "poor": "Low", "blank": "Low"}
    assert column(gf.stability_band(models, "report"), "stability")["fair"] == "Moderate"
    assert column(gf.stability_band(models, "plot"), "stability")["best"] == "Good"
    grades = column(gf.conclusion_grade(models), "conclusion")
    assert grades["best"].startswith("Excellent") and grades["fair"].startswith("Acceptable")
    assert grades["poor"].startswith("Poor")


def test_scorecard_keeps_models_without_folds(spark, models):
    cv = spark.createDataFrame([("best", 0.94, 0.01, 0.9, 0.02)],
                               "model_id string, mean_accuracy double, std_accuracy double,"
                               " mean_f1 double, std_f1 double")
    card = by(gf.scorecard(models.drop("std_accuracy"), cv), "model_id")
    assert card["best"]["stability"] == "High" and card["fair"]["stability"] == "Low"
    assert card["fair"]["mean_accuracy"] is None and len(card) == 4
