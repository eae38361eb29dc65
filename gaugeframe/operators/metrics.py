"""Classification metrics, all derived from one small table of (true, predicted) counts.

``by`` groups every metric by further columns, for instance a model id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeframe.functions.columns import ref, safe_div


def _refs(by: Sequence[str]) -> list[Column]:
    return [ref(c) for c in by]


def outcome_counts(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    count: str | None = None,
) -> DataFrame:
    """(by, t, p, n): at most classes squared rows per group, combined before the shuffle.

    ``count`` names a column with the number of rows that each input row stands for.
    """
    n = F.count("*") if count is None else F.sum(ref(count))
    return df.groupBy(*_refs(by), ref(label).alias("t"), ref(prediction).alias("p")).agg(
        n.alias("n"))


def _class_totals(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, class, support, predicted, hits) per class on either side of the counts."""
    zero = F.lit(0).cast("bigint")
    n = F.col("n")
    sides = F.array(
        F.struct(F.col("t").alias("class"), n.alias("support"), zero.alias("predicted"),
                 F.when(F.col("t") == F.col("p"), n).otherwise(zero).alias("hits")),
        F.struct(F.col("p").alias("class"), zero.alias("support"), n.alias("predicted"),
                 zero.alias("hits")),
    )
    return (
        cells.select(*_refs(by), F.inline(sides))
        .groupBy(*_refs(by), "class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )


def _with_prf(totals: DataFrame) -> DataFrame:
    hits, support, predicted = F.col("hits"), F.col("support"), F.col("predicted")
    return (
        totals.withColumn("precision", safe_div(hits, predicted))
        .withColumn("recall", safe_div(hits, support))
        .withColumn("f1_score", safe_div(2 * hits, support + predicted))
    )


def _weighted(metric: str) -> Column:
    weight = F.col("support")
    return safe_div(F.sum(weight * F.col(metric)), F.sum(weight))


def prob_to_label(df: DataFrame, prob: str, out: str = "prediction") -> DataFrame:
    """Binary probability: 1 above one half. Probability array: position of the first maximum."""
    p = ref(prob)
    if df.schema[prob].dataType.typeName() == "array":
        label = F.array_position(p, F.array_max(p)) - 1
    else:
        label = p > 0.5
    return df.withColumn(out, label.cast("int"))


def prediction_rows(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """(true, predicted, correct) per row."""
    return df.select(ref(label).alias("true"), ref(prediction).alias("predicted"),
                     (ref(label) == ref(prediction)).alias("correct"))


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", sparse: bool = False
) -> DataFrame:
    """(t, p, n) over the sorted union of true and predicted labels, zeros included.

    ``sparse`` lists only the cells that occur, never more than there are rows, which is the
    form for many classes.
    """
    cells = outcome_counts(df, label, prediction)
    if sparse:
        return cells
    # The zero cells come from the label list itself: one array, expanded on both sides. The
    # filter keeps the counts in this branch, so that both branches share one exchange.
    labels = cells.where(F.col("n") > 0).select(F.explode(F.array("t", "p")).alias("c")).agg(
        F.array_sort(F.collect_set("c")).alias("labels"))
    zeros = labels.select("labels", F.explode("labels").alias("t")).select(
        "t", F.explode("labels").alias("p"), F.lit(0).cast("bigint").alias("n"))
    return cells.unionByName(zeros).groupBy("t", "p").agg(F.sum("n").alias("n"))


def accuracy(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Share of rows predicted correctly."""
    hit = F.avg((ref(label) == ref(prediction)).cast("int"))
    return df.groupBy(*_refs(by)).agg(hit.alias("accuracy"))


def weighted_prf(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Support-weighted precision, recall and F1; a zero divisor counts as 0."""
    per_class = _with_prf(_class_totals(outcome_counts(df, label, prediction, by), by))
    return per_class.groupBy(*_refs(by)).agg(
        _weighted("precision").alias("precision"),
        _weighted("recall").alias("recall"),
        _weighted("f1_score").alias("f1"),
    )


def per_class_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    max_classes: int | None = None,
) -> DataFrame:
    """Precision, recall, F1 and support per class; with ``max_classes``, empty above it."""
    per_class = _with_prf(_class_totals(outcome_counts(df, label, prediction)))
    out = per_class.select("class", "precision", "recall", "f1_score", "support")
    if max_classes is not None and out.limit(max_classes + 1).count() > max_classes:
        return out.limit(0)
    return out


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Per-class rows followed by accuracy, macro average and weighted average."""
    per_class = per_class_metrics(df, label, prediction, max_classes=None)
    names = ("precision", "recall", "f1_score")
    classes = per_class.select(F.col("class").cast("string").alias("name"), *names, "support")
    hits = F.sum(F.col("recall") * F.col("support"))
    acc = safe_div(hits, F.sum("support"))
    summary = per_class.agg(
        F.inline(F.array(
            F.struct(F.lit("accuracy").alias("name"), *[acc.alias(m) for m in names],
                     F.sum("support").alias("support")),
            F.struct(F.lit("macro avg").alias("name"), *[F.avg(m).alias(m) for m in names],
                     F.sum("support").alias("support")),
            F.struct(F.lit("weighted avg").alias("name"),
                     *[_weighted(m).alias(m) for m in names], F.sum("support").alias("support")),
        ))
    )
    return classes.unionByName(summary)


def _row_shares(cells: DataFrame, kept: Column) -> DataFrame:
    """Each kept cell over the sum of its true row's kept cells, 0 where that sum is 0."""
    value = F.when(kept, F.col("n")).otherwise(0)
    # The rows' totals are joined, so no row's cells are gathered in one place.
    totals = cells.groupBy(F.col("t").alias("row")).agg(F.sum(value).alias("total"))
    return cells.join(totals, F.col("t").eqNullSafe(F.col("row"))).select(
        "t", "p", safe_div(value, F.col("total")).alias("share"))


def confusion_normalized(
    df: DataFrame, label: str = "label", prediction: str = "prediction", sparse: bool = False
) -> DataFrame:
    """Confusion counts as shares of their true class; ``sparse`` as in ``confusion_matrix``."""
    return _row_shares(confusion_matrix(df, label, prediction, sparse), F.lit(True))


def error_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", sparse: bool = False
) -> DataFrame:
    """Mistakes as shares of all mistakes of their true class, 0 on the diagonal.

    ``sparse`` lists only the mistakes that occur.
    """
    wrong = F.col("t") != F.col("p")
    cells = confusion_matrix(df, label, prediction, sparse)
    return _row_shares(cells.where(wrong) if sparse else cells, wrong)


def top_error(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Totals, accuracy and the most frequent mistake (lowest true, then predicted, on ties)."""
    cells = outcome_counts(df, label, prediction)
    wrong = F.col("t") != F.col("p")
    worst = F.min(F.when(wrong, F.struct((-F.col("n")).alias("n"), "t", "p")))
    return cells.agg(
        F.sum("n").alias("total"),
        F.sum(F.when(wrong, 0).otherwise(F.col("n"))).alias("correct"),
        F.sum(F.when(wrong, F.col("n")).otherwise(0)).alias("incorrect"),
        worst.alias("worst"),
    ).select(
        "total", "correct", "incorrect",
        safe_div(F.col("correct"), F.col("total")).alias("accuracy"),
        F.col("worst.t").alias("error_true"), F.col("worst.p").alias("error_predicted"),
        (-F.col("worst.n")).alias("error_count"),
    )


def prediction_distribution(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Correct and incorrect rows with their share."""
    right = F.count_if(ref(label) == ref(prediction)).alias("right")
    return df.agg(right, F.count("*").alias("n")).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("outcome"), count.alias("count"),
                 (safe_div(count, F.col("n")) * 100).alias("percentage"))
        for name, count in (("correct", F.col("right")),
                            ("incorrect", F.col("n") - F.col("right")))
    ])))


def class_accuracy_band(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Accuracy per class, 0 for a class that never occurs, with its colour band."""
    totals = _class_totals(outcome_counts(df, label, prediction))
    acc = F.col("accuracy")
    return totals.select("class", safe_div(F.col("hits"), F.col("support")).alias("accuracy")
                         ).withColumn("band", F.when(acc > 0.7, "green")
                                      .when(acc > 0.5, "orange").otherwise("red"))


def auc_from_labels(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """AUC of hard binary predictions: the mean of true positive and true negative rate."""
    y, p = ref(label), ref(prediction)
    tpr = F.try_divide(F.count_if((y == 1) & (p == 1)).cast("double"), F.count_if(y == 1))
    tnr = F.try_divide(F.count_if((y == 0) & (p == 0)).cast("double"), F.count_if(y == 0))
    return df.agg(((tpr + tnr) / 2).alias("auc"))


def classification_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    max_classes: int | None = None,
    count: str | None = None,
) -> DataFrame:
    """One row per group: headline metrics, per-class arrays and error counts.

    ``roc_auc`` is the hard-label AUC for two true classes and NULL otherwise; join a
    probability-based AUC for more. With ``max_classes``, ``per_class`` is NULL above it. With
    ``count``, the input is a table of ``outcome_counts``, possibly of a finer grouping: one
    scan of the predictions then serves the metrics per fold and per model.
    """
    cells = outcome_counts(df, label, prediction, by, count)
    per_class = _with_prf(_class_totals(cells, by))
    seen = F.collect_list(F.struct("class", "precision", "recall", "f1_score", "support"))
    listed = F.array_sort(seen)
    if max_classes is not None:
        listed = F.when(F.count("*") <= max_classes, listed)
    truths = F.count_if(F.col("support") > 0)
    correct, total = F.sum("hits"), F.sum("support")
    mean_recall = safe_div(F.sum(F.when(F.col("support") > 0, F.col("recall"))), truths)
    return per_class.groupBy(*_refs(by)).agg(
        safe_div(correct, total).alias("accuracy"),
        _weighted("precision").alias("precision_weighted"),
        _weighted("recall").alias("recall_weighted"),
        _weighted("f1_score").alias("f1_weighted"),
        F.when(truths == 2, mean_recall).alias("roc_auc"),
        listed.alias("per_class"),
        correct.alias("correct"),
        (total - correct).alias("incorrect"),
    )
