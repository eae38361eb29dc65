"""Training histories and cross-validation results, for many runs at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CV_METRICS = ("accuracy", "precision", "recall", "f1")


def training_summary(history: DataFrame, max_epochs: int = 100, by: str = "run_id") -> DataFrame:
    """Best, final and gap figures per run from (run, epoch, loss, val_loss, accuracy, ...).

    Ties go to the earliest epoch. ``lr`` is optional.
    """
    epoch = F.col("epoch")

    def last(c: str):
        return F.max_by(c, epoch)

    aggs = [
        F.count("*").alias("total_epochs"),
        F.min(F.struct("val_loss", "epoch")).alias("by_loss"),
        F.min(F.struct((-F.col("val_accuracy")).alias("v"), "epoch")).alias("by_accuracy"),
        last("loss").alias("final_training_loss"),
        last("accuracy").alias("final_training_accuracy"),
        last("val_loss").alias("final_validation_loss"),
        last("val_accuracy").alias("final_validation_accuracy"),
    ]
    cols = [
        by, "total_epochs",
        F.col("by_loss.epoch").alias("best_epoch_by_val_loss"),
        F.col("by_accuracy.epoch").alias("best_epoch_by_val_accuracy"),
        "final_training_loss", "final_training_accuracy",
        "final_validation_loss", "final_validation_accuracy",
        F.col("by_loss.val_loss").alias("best_validation_loss"),
        (-F.col("by_accuracy.v")).alias("best_validation_accuracy"),
        (F.col("final_training_loss") - F.col("final_validation_loss")).alias("loss_gap"),
        (F.col("final_validation_accuracy") - F.col("final_training_accuracy"))
        .alias("accuracy_gap"),
        (F.col("total_epochs") < max_epochs).alias("early_stopping_triggered"),
    ]
    if "lr" in history.columns:
        aggs += [F.min_by("lr", epoch).alias("initial_lr"), last("lr").alias("final_lr"),
                 (F.min("lr") != F.max("lr")).alias("lr_reduced")]
        cols += ["initial_lr", "final_lr", "lr_reduced"]
    return history.groupBy(by).agg(*aggs).select(*cols)


def loss_gap(history: DataFrame) -> DataFrame:
    """Training minus validation loss per epoch, and which side is larger."""
    gap = F.col("loss") - F.col("val_loss")
    side = F.when(gap > 0, "train > val").when(gap < 0, "val > train").otherwise("equal")
    return history.select("run_id", "epoch", gap.alias("loss_gap"), side.alias("larger"))


def cv_summary(
    folds: DataFrame, metrics: Sequence[str] = CV_METRICS, by: str = "model_id"
) -> DataFrame:
    """Mean, population std, minimum and maximum of each fold metric per model."""
    aggs = [F.count("*").alias("n_folds")]
    for m in metrics:
        aggs += [F.avg(m).alias(f"mean_{m}"), F.stddev_pop(m).alias(f"std_{m}"),
                 F.min(m).alias(f"min_{m}"), F.max(m).alias(f"max_{m}")]
    return folds.groupBy(by).agg(*aggs)
