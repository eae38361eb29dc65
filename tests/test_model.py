import json

import pytest

import gaugeframe as gf


@pytest.fixture(scope="module")
def blobs(spark):
    return spark.range(300).selectExpr(
        "id", "id % 3 as label", "(id % 3) * 2 + sin(id) * 0.4 as `a b`",
        "cos(id) * 0.4 - (id % 3) as b", "id % 2 = 0 as flag")


FEATURES = ["a b", "b", "flag"]


@pytest.mark.parametrize("kind", ["mlp", "logreg", "rf"])
def test_fit_and_predict(blobs, kind):
    fitted = gf.fit_classifier(blobs, FEATURES, kind=kind, hidden=(8,), max_iter=60)
    scored = gf.predict(fitted, blobs)
    assert gf.accuracy(scored).first()["accuracy"] > 0.95
    row = scored.first()
    assert len(row["probability"]) == 3 and sum(row["probability"]) == pytest.approx(1)
    assert row["prediction"] == max(range(3), key=lambda i: row["probability"][i])


def test_unknown_kind_and_no_rows(blobs):
    with pytest.raises(ValueError, match="unknown classifier"):
        gf.fit_classifier(blobs, FEATURES, kind="tree")
    with pytest.raises(ValueError, match="no training rows"):
        gf.fit_classifier(blobs.where("id < 0"), FEATURES)


def test_early_stopping_keeps_the_best_round(blobs):
    rows = gf.stratified_split(blobs, "label", key="id")
    fitted, history = gf.fit_early_stopping(
        rows.where("split = 'train'"), rows.where("split = 'val'"), FEATURES, rounds=6,
        patience=2, hidden=(6,), select_by="val_loss", solver="gd")
    epochs = [r.asDict() for r in history.orderBy("epoch").collect()]
    assert 1 <= len(epochs) <= 6 and [e["epoch"] for e in epochs] == list(
        range(1, len(epochs) + 1))
    assert gf.training_summary(history, 6).first()["total_epochs"] == len(epochs)
    assert gf.predict(fitted, rows).count() == 300
    with pytest.raises(ValueError):
        gf.fit_early_stopping(rows, rows, FEATURES, select_by="loss")


@pytest.mark.parametrize("options", [{"kind": "logreg", "parallelism": 3},
                                     {"rounds": 2, "hidden": (4,)}])
def test_cross_validation(blobs, options):
    folds = gf.cross_validate(gf.kfold_assign(blobs, 3, key="id"), FEATURES, **options)
    rows = folds.collect()
    assert sorted(r["fold"] for r in rows) == [0, 1, 2]
    assert all(0 <= r["accuracy"] <= 1 for r in rows)
    assert gf.cv_summary(folds).first()["n_folds"] == 3


def test_model_round_trip(spark, blobs, tmp_path):
    fitted = gf.fit_classifier(blobs, FEATURES, kind="logreg")
    gf.save_model(fitted, str(tmp_path / "m"))
    again = gf.load_model(str(tmp_path / "m"))
    a, b = (gf.predict(m, blobs).select("id", "prediction").orderBy("id").collect()
            for m in (fitted, again))
    assert a == b


def test_raw_rows_to_report(spark, tmp_path):
    raw = spark.range(400).selectExpr(
        "id", "if(id % 11 = 0, null, (id % 4) * 3 + sin(id)) as x", "cos(id) as z",
        "concat('k', id % 4) as kind", "concat('c', id % 4) as y")
    ready = gf.prepare(raw, "y", key="id", exclude=["id"])
    fitted, scored = gf.train_and_test(ready, kind="logreg", max_iter=30)
    folds, summary = gf.cross_validation(ready, 3, kind="logreg", max_iter=10)
    card = gf.report(scored, summary)
    gf.write_metrics(card, str(tmp_path / "out"))
    line = spark.read.text(str(tmp_path / "out")).first()[0]
    got = json.loads(line)
    assert got["accuracy"] > 0.9 and got["roc_auc"] > 0.9 and got["stability"] == "High"
    assert folds.count() == 3
    gf.write_splits(ready.df, str(tmp_path / "splits"))
    back = spark.read.parquet(str(tmp_path / "splits"))
    assert back.where("split = 'test'").count() == 60


def test_casts_and_xy(blobs):
    out = gf.cast_model_types(blobs, ["b"], "label")
    assert out.dtypes == [("b", "float"), ("label", "int")]
    features, target = gf.split_xy(blobs, "a b")
    assert "a b" not in features.columns and target.columns == ["a b"]
