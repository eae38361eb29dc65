"""Fit a classifier on a prepared table, score its test rows, and collect the results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from types import MappingProxyType
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeframe.functions.columns import ref
from gaugeframe.operators import metrics, model, roc, split, training, verdict
from gaugeframe.plans.preparation import KEY, Prepared


def train_and_test(
    prepared: Prepared,
    kind: str = "mlp",
    hidden: Sequence[int] = model.HIDDEN,
    max_iter: int = 100,
    seed: int = 42,
) -> tuple[PipelineModel, DataFrame]:
    """The fitted model and the scored test rows."""
    train = prepared.df.where(F.col("split") == "train")
    test = prepared.df.where(F.col("split") == "test")
    fitted = model.fit_classifier(
        train, prepared.features, "label", kind, hidden, max_iter, seed=seed)
    return fitted, model.predict(fitted, test)


class Trained(NamedTuple):
    """A fitted model, its scored test rows, and the history of its training."""

    model: PipelineModel
    scored: DataFrame
    history: DataFrame


def train_with_stopping(
    prepared: Prepared,
    hidden: Sequence[int] = model.HIDDEN,
    rounds: int = 100,
    patience: int = model.PATIENCE,
    seed: int = 42,
    state: str | None = None,
    model_id: str = "model",
    **options,
) -> Trained:
    """Train on ``train`` until the loss on ``val`` stops improving, and score ``test``.

    The history has one row per round, named ``model_id``, as ``training_summary`` and
    ``loss_gap`` take it. ``state`` is a folder to resume from; see ``fit_early_stopping``.
    """
    part = {name: prepared.df.where(F.col("split") == name) for name in ("train", "val", "test")}
    fitted, history = model.fit_early_stopping(
        part["train"], part["val"], prepared.features, "label", rounds, patience=patience,
        hidden=hidden, seed=seed, state=state, **options)
    return Trained(fitted, model.predict(fitted, part["test"]),
                   history.withColumn("run_id", F.lit(model_id)))


def evaluate(scored: DataFrame, model_id: str = "model") -> DataFrame:
    """Metrics of scored rows; the AUC of more than two classes is one-vs-rest."""
    named = scored.withColumn("model_id", F.lit(model_id))
    out = metrics.classification_metrics(named, "label", "prediction", ["model_id"])
    if "probability" not in scored.columns:
        return out
    area = roc.macro_auc(roc.roc_curve_ovr(scored, "label", "probability")).scalar()
    return out.withColumn("roc_auc", F.coalesce("roc_auc", area))


def cross_validation(
    prepared: Prepared, k: int = 5, kind: str = "mlp", seed: int = 42, **options
) -> tuple[DataFrame, DataFrame]:
    """(per-fold metrics, their summary) over the training and validation rows."""
    rows = split.train_full(prepared.df)
    folds = model.cross_validate(
        split.kfold_assign(rows, k, seed, KEY), prepared.features, "label",
        kind=kind, seed=seed, **options)
    return folds, training.cv_summary(folds)


def report(scored: DataFrame, cv: DataFrame, model_id: str = "model",
           missing: DataFrame | None = None) -> DataFrame:
    """One scorecard row, the input of ``write_metrics``; ``missing`` is that of A19."""
    return verdict.scorecard(evaluate(scored, model_id),
                             cv.withColumn("model_id", F.lit(model_id)), missing=missing)


def results_tree(
    tests: DataFrame,
    cells: DataFrame,
    folds: DataFrame,
    history: DataFrame,
    by: str = "model_id",
    missing: DataFrame | None = None,
    settings: Mapping[str, object] = MappingProxyType({}),
    max_epochs: int = 100,
) -> DataFrame:
    """Everything known of each model as one nested row, the input of ``write_metrics``.

    ``tests`` has its test metrics, ``cells`` its confusion counts ``(by, t, p, n)``, ``folds`` its
    fold metrics and ``history`` its rounds (named by ``run_id``). ``preparation`` holds the numbers
    of ``missing_totals`` and the ``settings`` as text, ``training`` the summary and the rounds,
    ``test`` the metrics and cells, ``cross_validation`` summary and folds, ``verdict`` the rest of
    the scorecard. A part that a model does not have is null; lists are sorted.
    """
    def listed(df: DataFrame, name: str) -> DataFrame:
        # At most the classes' pairs, the folds or the rounds of one model.
        rest = [c for c in df.columns if c != by]
        return df.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias(name))

    rounds = history.withColumnRenamed("run_id", by).withColumn(by, ref(by).cast(tests.schema[by].dataType))
    learned = training.training_summary(rounds, max_epochs, by)
    summary = training.cv_summary(folds, by=by)
    graded = verdict.scorecard(tests, summary, by)
    judged = ["stability", "strengths", "weaknesses", "recommendations", "conclusion"]

    def one(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
        return df.select(by, F.struct(*columns).alias(name))

    def columns(df: DataFrame) -> list[str]:
        return [c for c in df.columns if c != by]

    out = one(tests, "test_metrics", columns(tests))
    for part in (listed(cells, "cells"), one(learned, "summary", columns(learned)),
                 listed(rounds.select(by, "epoch", *[c for c in rounds.columns if c not in (by, "epoch")]),
                        "rounds"),
                 one(summary, "cv", columns(summary)),
                 listed(folds.select(by, "fold", *[c for c in folds.columns if c not in (by, "fold")]),
                        "folds"), one(graded, "verdict", judged)):
        out = out.join(part, by, "left")
    totals = missing.first().asDict() if missing is not None else {}
    prepared = F.struct(
        *[F.lit(totals.get(c)).cast("bigint").alias(c) for c in ("missing_before", "missing_after")],
        F.map_from_arrays(*[F.array(*[F.lit(str(x)) for x in part]).cast("array<string>")
                            for part in (settings.keys(), settings.values())]).alias("settings"))
    return out.select(
        by, prepared.alias("preparation"),
        F.struct("summary", "rounds").alias("training"),
        F.struct(F.col("test_metrics").alias("metrics"), "cells").alias("test"),
        F.struct(F.col("cv").alias("summary"), "folds").alias("cross_validation"), "verdict")
