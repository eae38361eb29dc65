"""Distributed classifiers on Spark ML: fitting, early stopping, scoring, cross-validation."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    LogisticRegression,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeframe.functions.columns import ref, small_table
from gaugeframe.operators import metrics

FEATURES, LABEL = "features", "label"
PROBABILITY, PREDICTION = "probability", "prediction"
HIDDEN = (64, 32, 16)
PATIENCE = 15
MIN_STEP = 1e-6
FLOOR = 1e-7
HISTORY = ("run_id string, epoch int, loss double, val_loss double, accuracy double,"
           " val_accuracy double, lr double")


def cast_model_types(df: DataFrame, features: Sequence[str], label: str | None = None) -> DataFrame:
    """Features as float, the label as int, everything else dropped."""
    out = [ref(c).cast("float").alias(c) for c in features]
    if label is not None:
        out.append(ref(label).cast("int").alias(label))
    return df.select(*out)


def split_xy(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """(features without the target, the target alone)."""
    return df.select(*[ref(c) for c in df.columns if c != target]), df.select(ref(target))


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="error")


def _vectors(
    df: DataFrame, features: Sequence[str], label: str
) -> tuple[DataFrame, VectorAssembler]:
    assembler = _assembler(features)
    kept = [c for c in ("split", "fold") if c in df.columns]
    rows = assembler.transform(df).select(
        FEATURES, ref(label).cast("double").alias(LABEL), *kept)
    return rows, assembler


def _n_classes(vectors: DataFrame) -> int:
    top = vectors.agg(F.max(LABEL).alias("m")).first()["m"]
    if top is None:
        raise ValueError("no training rows")
    return max(int(top) + 1, 2)


def _width(vectors: DataFrame) -> int:
    return vectors.select(FEATURES).first()[FEATURES].size


def _estimator(
    kind: str, layers: Sequence[int], max_iter: int, reg: float, seed: int, tol: float = 1e-6
):
    if kind == "mlp":
        return MultilayerPerceptronClassifier(
            layers=list(layers), maxIter=max_iter, seed=seed, blockSize=128,
            featuresCol=FEATURES, labelCol=LABEL)
    if kind == "logreg":
        return LogisticRegression(
            maxIter=max_iter, regParam=reg, tol=tol, featuresCol=FEATURES, labelCol=LABEL)
    if kind == "rf":
        return RandomForestClassifier(seed=seed, featuresCol=FEATURES, labelCol=LABEL)
    raise ValueError(f"unknown classifier {kind!r}: use mlp, logreg or rf")


def _persisted(rows: DataFrame) -> DataFrame:
    return rows.persist(StorageLevel.MEMORY_AND_DISK)


def fit_classifier(
    df: DataFrame,
    features: Sequence[str],
    label: str = LABEL,
    kind: str = "mlp",
    hidden: Sequence[int] = HIDDEN,
    max_iter: int = 100,
    reg: float = 0.001,
    seed: int = 42,
    tol: float = 1e-6,
) -> PipelineModel:
    """Fit a classifier on numeric features and labels 0..C-1; ``reg`` and ``tol`` are those of
    ``logreg``."""
    rows, assembler = _vectors(df, features, label)
    rows = _persisted(rows)
    try:
        layers = [len(features), *hidden, _n_classes(rows)]
        model = _estimator(kind, layers, max_iter, reg, seed, tol).fit(rows)
    finally:
        rows.unpersist()
    return PipelineModel(stages=[assembler, model])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add class probabilities as an array and the predicted label."""
    scored = model.transform(df)
    out = [ref(c) for c in df.columns if c not in (PROBABILITY, PREDICTION)]
    scored = scored.select(*out, vector_to_array(PROBABILITY).alias(PROBABILITY))
    return metrics.prob_to_label(scored, PROBABILITY, PREDICTION)


def _loss_and_accuracy(model, rows: DataFrame) -> dict[str, tuple[float, float]]:
    """Mean log loss and accuracy per split, in one pass."""
    p = vector_to_array(PROBABILITY)
    own = F.greatest(F.get(p, F.col(LABEL).cast("int")), F.lit(FLOOR))
    found = (
        model.transform(rows)
        .select("split", (-F.log(own)).alias("loss"),
                (F.col(PREDICTION) == F.col(LABEL)).cast("int").alias("hit"))
        .groupBy("split")
        .agg(F.avg("loss").alias("loss"), F.avg("hit").alias("accuracy"))
        .collect()
    )
    return {r["split"]: (r["loss"], r["accuracy"]) for r in found}


@dataclass
class _Progress:
    """Where a training in rounds stands; written after every round if it has a folder."""

    weights: list[float] | None
    step: float
    history: list[tuple]
    best_epoch: int = 0
    best_score: float | None = None
    low: float = math.inf
    since_low: int = 0
    since_step: int = 0

    def stopped(self, patience: int) -> bool:
        return self.since_low >= patience


STATE = ("settings string, epoch int, step double, best_epoch int, best_score double, low double,"
         " since_low int, since_step int, weights array<double>,"
         f" history array<struct<{HISTORY.replace(' ', ':').replace(',:', ',')}>>")


def _store(spark, state: str, settings: str, p: _Progress) -> None:
    """One row per round. Its file appears at once, so a run that is stopped while it writes goes
    on from the round before."""
    row = (settings, len(p.history), p.step, p.best_epoch, p.best_score, p.low, p.since_low,
           p.since_step, [float(w) for w in p.weights], p.history)
    spark.createDataFrame([row], STATE).coalesce(1).write.mode("overwrite").parquet(
        f"{state}/rounds/round={len(p.history)}")


def _resume(spark, state: str, settings: str) -> _Progress | None:
    """The last complete round in a folder; None if there is none."""
    try:
        rounds = spark.read.schema(STATE).parquet(f"{state}/rounds")
        row = rounds.orderBy(F.desc("epoch")).head()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if row is None:
        return None
    if row["settings"] != settings:
        raise ValueError(f"{state} holds a training with other settings: {row['settings']}")
    return _Progress(list(row["weights"]), row["step"], [tuple(h) for h in row["history"]],
                     row["best_epoch"], row["best_score"], row["low"], row["since_low"],
                     row["since_step"])


def fit_early_stopping(
    train: DataFrame,
    val: DataFrame,
    features: Sequence[str],
    label: str = LABEL,
    rounds: int = 100,
    iterations: int = 10,
    patience: int = PATIENCE,
    select_by: str = "val_accuracy",
    hidden: Sequence[int] = HIDDEN,
    solver: str = "l-bfgs",
    step: float = 0.03,
    seed: int = 42,
    state: str | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """Short warm-started rounds until validation loss stops improving.

    Returns the best model by ``select_by`` (``val_accuracy`` or ``val_loss``) and the
    history, one row per round. With ``solver="gd"`` the step is halved after half the
    patience without improvement.

    ``state`` names a folder that all executors reach: every round stores its weights, rate,
    history and the best model there, and a later call with the same settings goes on after the
    last complete round (more ``rounds`` or ``patience`` are allowed). Rounds are warm-started from
    weights alone, so a resumed run equals one that was never stopped.
    """
    if select_by not in ("val_accuracy", "val_loss"):
        raise ValueError("select_by must be 'val_accuracy' or 'val_loss'")
    rows_t, assembler = _vectors(train.drop("split", "fold"), features, label)
    rows_v, _ = _vectors(val.drop("split", "fold"), features, label)
    model, history = _train_rounds(
        rows_t, rows_v, rounds, iterations, patience, select_by, hidden, solver, step, seed, state)
    table = small_table(train.sparkSession, history, HISTORY)
    return PipelineModel(stages=[assembler, model]), table


def _train_rounds(
    train: DataFrame, val: DataFrame, rounds: int, iterations: int, patience: int,
    select_by: str, hidden: Sequence[int], solver: str, step: float, seed: int,
    state: str | None = None,
):
    """The best model and the history rows, from (features, label) vectors."""
    spark = train.sparkSession
    both = train.select(FEATURES, LABEL, F.lit("train").alias("split")).unionByName(
        val.select(FEATURES, LABEL, F.lit("val").alias("split")))
    rows = _persisted(both)
    fit_rows = rows.where(F.col("split") == "train")
    try:
        layers = [_width(rows), *hidden, _n_classes(rows)]
        settings = str((layers, iterations, select_by, solver, step, seed))
        p = _resume(spark, state, settings) if state else None
        best = None
        if p is None:
            p = _Progress(None, step, [])
        elif p.best_epoch:
            best = MultilayerPerceptronClassificationModel.load(f"{state}/best-{p.best_epoch}")
        for epoch in range(len(p.history) + 1, rounds + 1):
            if p.stopped(patience):
                break
            learner = MultilayerPerceptronClassifier(
                layers=layers, maxIter=iterations, seed=seed, solver=solver, stepSize=p.step,
                blockSize=128, featuresCol=FEATURES, labelCol=LABEL)
            if p.weights is not None:
                learner = learner.setInitialWeights(Vectors.dense(p.weights))
            model = learner.fit(fit_rows)
            p.weights = model.weights.toArray()
            found = _loss_and_accuracy(model, rows)
            (loss, acc), (val_loss, val_acc) = found["train"], found["val"]
            rate = p.step if solver == "gd" else None
            p.history.append(("fit", epoch, loss, val_loss, acc, val_acc, rate))
            score = val_acc if select_by == "val_accuracy" else -val_loss
            if p.best_score is None or score > p.best_score:
                best, p.best_score, p.best_epoch = model, score, epoch
                if state:
                    best.write().overwrite().save(f"{state}/best-{epoch}")
            if val_loss < p.low:
                p.low, p.since_low, p.since_step = val_loss, 0, 0
            else:
                p.since_low, p.since_step = p.since_low + 1, p.since_step + 1
            if solver == "gd" and not p.stopped(patience) and p.since_step >= max(patience // 2, 1):
                p.step, p.since_step = max(p.step / 2, MIN_STEP), 0
            if state:
                _store(spark, state, settings, p)
    finally:
        rows.unpersist()
    return best, p.history


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    label: str = LABEL,
    kind: str = "mlp",
    hidden: Sequence[int] = HIDDEN,
    max_iter: int = 50,
    reg: float = 0.001,
    rounds: int = 0,
    patience: int = 10,
    parallelism: int = 1,
    seed: int = 42,
    tol: float = 1e-6,
) -> DataFrame:
    """Per ``fold`` of the input: fit on the other folds, score on it.

    With ``rounds`` above 0 each fold trains by early stopping against the held-out fold.
    Returns (model_id, fold, accuracy, precision, recall, f1).
    """
    rows, _ = _vectors(df, features, label)
    rows = _persisted(rows)
    try:
        folds = sorted(r["fold"] for r in rows.select("fold").distinct().collect())
        layers = [len(features), *hidden, _n_classes(rows)]

        def one(fold: int) -> tuple:
            rest, held = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
            if rounds:
                model, _ = _train_rounds(rest, held, rounds, 10, patience, "val_loss",
                                         hidden, "l-bfgs", 0.03, seed)
            else:
                model = _estimator(kind, layers, max_iter, reg, seed, tol).fit(rest)
            scored = model.transform(held).select(LABEL, F.col(PREDICTION))
            m = metrics.classification_metrics(scored, LABEL, PREDICTION).first()
            return (kind, fold, m["accuracy"], m["precision_weighted"], m["recall_weighted"],
                    m["f1_weighted"])

        if parallelism > 1:
            run: Callable = inheritable_thread_target(df.sparkSession)(one)
            with ThreadPool(parallelism) as pool:
                scores = pool.map(run, folds)
        else:
            scores = [one(f) for f in folds]
    finally:
        rows.unpersist()
    return small_table(
        df.sparkSession, scores,
        "model_id string, fold int, accuracy double, precision double, recall double, f1 double")
