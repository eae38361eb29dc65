"""Verdicts per model: strengths, weaknesses, recommendations, bands, scorecard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The texts a report must show.
HIGH_ACCURACY = "High overall accuracy"
GOOD_ACCURACY = "Good overall accuracy"
ACCEPTABLE_ACCURACY = "Acceptable accuracy"
BALANCED_F1 = "Balanced precision and recall (good F1-score)"
EVEN_CLASSES = "Consistent performance across all classes"
HIGH_AUC = "Excellent discriminative power (high AUC)"
BASELINE = "Baseline performance achieved"

LOW_ACCURACY = "Low overall accuracy"
POOR_F1 = "Poor balance between precision and recall"
POOR_CLASSES = "Poor performance on some classes"
UNEVEN_SUPPORT = "Class imbalance affecting performance"
LOW_AUC = "Limited discriminative power"
VARIABLE_FOLDS = "Variable performance across cross-validation folds"

FOR_ACCURACY = [
    "Consider more complex model architecture",
    "Increase training data or use data augmentation",
    "Perform more extensive feature engineering",
]
FOR_F1 = "Address class imbalance with techniques like SMOTE or class weighting"
FOR_FOLDS = [
    "Model performance is variable - consider ensemble methods",
    "Increase cross-validation folds for more reliable estimates",
    "Check for data leakage or preprocessing inconsistencies",
]
FOR_ERRORS = "High misclassification rate - consider different algorithm or features"
GENERAL = [
    "Experiment with different neural network architectures",
    "Perform hyperparameter tuning (learning rate, dropout, layers)",
    "Try different activation functions or optimizers",
    "Consider feature selection to reduce dimensionality",
]

CONCLUSIONS = [
    (0.9, "Excellent performance achieved. The model is highly effective for this"
          " classification task."),
    (0.8, "Good performance achieved. The model is suitable for deployment with monitoring."),
    (0.7, "Acceptable performance achieved. Consider further optimization for production use."),
    (0.6, "Marginal performance achieved. Significant improvements needed before deployment."),
]
POOR_CONCLUSION = ("Poor performance. Consider revisiting problem formulation, data quality, or"
                   " algorithm selection.")

BAND_NAMES = {
    "summary": ("High", "Medium", "Low"),
    "report": ("High", "Moderate", "Variable"),
    "plot": ("Good", "Moderate", "Variable"),
}


def _or(name: str, default: float) -> Column:
    return F.coalesce(F.col(name), F.lit(default))


def _texts(*items: Column) -> Column:
    """The conditional texts that apply, in order."""
    return F.array_compact(F.array(*items))


def _all(condition: Column, texts: list[str]) -> Column:
    empty = F.array().cast("array<string>")
    return F.when(condition, F.array(*[F.lit(t) for t in texts])).otherwise(empty)


def strengths(metrics: DataFrame, style: str = "summary") -> DataFrame:
    """Add ``strengths``; ``style="report"`` uses the report's shorter ladder."""
    acc, f1 = _or("accuracy", 0.0), _or("f1_weighted", 0.0)
    ladder = F.when(acc > 0.85, HIGH_ACCURACY).when(acc > 0.75, GOOD_ACCURACY)
    balanced = F.when(f1 > 0.8, BALANCED_F1)
    if style == "report":
        ladder = ladder.when(acc > 0.65, ACCEPTABLE_ACCURACY).otherwise(BASELINE)
        return metrics.withColumn("strengths", _texts(ladder, balanced))
    even = F.forall("per_class", lambda m: m["f1_score"] > 0.7) & (F.size("per_class") > 0)
    found = _texts(ladder, balanced, F.when(even, EVEN_CLASSES),
                   F.when(_or("roc_auc", 0.5) > 0.8, HIGH_AUC))
    return metrics.withColumn(
        "strengths", F.when(F.size(found) == 0, F.array(F.lit(BASELINE))).otherwise(found))


def weaknesses(metrics: DataFrame, style: str = "summary") -> DataFrame:
    """Add ``weaknesses``; ``style="report"`` also looks at ``std_accuracy`` of the folds."""
    low = F.when(_or("accuracy", 0.0) < 0.6, LOW_ACCURACY)
    poor = F.when(_or("f1_weighted", 0.0) < 0.6, POOR_F1)
    if style == "report":
        variable = F.when(_or("std_accuracy", 0.0) > 0.1, VARIABLE_FOLDS)
        return metrics.withColumn("weaknesses", _texts(low, poor, variable))
    weak = F.exists("per_class", lambda m: m["f1_score"] < 0.5)
    support = F.transform("per_class", lambda m: m["support"])
    # A product instead of a quotient: a class without support counts as uneven.
    uneven = F.array_max(support) > 10 * F.array_min(support)
    return metrics.withColumn("weaknesses", _texts(
        low, poor, F.when(weak, POOR_CLASSES), F.when(uneven, UNEVEN_SUPPORT),
        F.when(_or("roc_auc", 0.5) < 0.7, LOW_AUC)))


def recommendations(metrics: DataFrame) -> DataFrame:
    """Add ``recommendations`` from accuracy, F1, fold spread and error counts."""
    acc, f1 = _or("accuracy", 0.0), _or("f1_weighted", 0.0)
    spread = _or("std_accuracy", 0.0) if "std_accuracy" in metrics.columns else F.lit(0.0)
    errors = F.coalesce(F.col("incorrect") > F.col("correct") * 0.5, F.lit(False))
    return metrics.withColumn("recommendations", F.concat(
        _all(acc < 0.7, FOR_ACCURACY),
        _all(f1 < acc * 0.9, [FOR_F1]),
        _all(spread > 0.1, FOR_FOLDS),
        _all(errors, [FOR_ERRORS]),
        F.array(*[F.lit(t) for t in GENERAL]),
    ))


def stability_band(cv: DataFrame, names: str = "summary") -> DataFrame:
    """Add ``stability`` from the spread of fold accuracy; no spread known is the worst band."""
    best, middle, worst = BAND_NAMES[names]
    std = _or("std_accuracy", 1.0)
    return cv.withColumn(
        "stability", F.when(std < 0.05, best).when(std < 0.1, middle).otherwise(worst))


def conclusion_grade(metrics: DataFrame) -> DataFrame:
    """Add ``conclusion`` by accuracy."""
    acc = _or("accuracy", 0.0)
    grade = None
    for bound, text in CONCLUSIONS:
        grade = F.when(acc > bound, text) if grade is None else grade.when(acc > bound, text)
    return metrics.withColumn("conclusion", grade.otherwise(POOR_CONCLUSION))


def scorecard(
    metrics: DataFrame, cv: DataFrame, by: str = "model_id", missing: DataFrame | None = None
) -> DataFrame:
    """One row per model: headline and fold metrics with every verdict.

    ``missing`` is the row of ``missing_totals``; its two numbers are added if it is given.
    """
    joined = metrics.join(
        cv.select(by, "mean_accuracy", "std_accuracy", "mean_f1", "std_f1"), by, "left")
    graded = conclusion_grade(recommendations(weaknesses(strengths(stability_band(joined)))))
    totals = missing.first().asDict() if missing is not None else {}
    return graded.select(
        by, "accuracy", "precision_weighted", "recall_weighted", "f1_weighted", "roc_auc",
        "mean_accuracy", "std_accuracy", "mean_f1", "std_f1", "stability", "strengths",
        "weaknesses", "recommendations", "conclusion",
        *[F.lit(n).cast("bigint").alias(c) for c, n in totals.items()],
    )
