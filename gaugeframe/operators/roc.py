"""ROC curves and areas over any number of rows.

A running sum over all scores in one window would be one task. Scores are counted per distinct
value first. The counts are then cut into ranges of scores and stored; the totals of each range
are summed up in order, and each range adds the total of those before it to its own running sums.
Equal scores are one row by then, so no score can make a range large.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeframe.functions.columns import nan_to_null, ref
from gaugeframe.sources.scratch import materialize

ROWS_PER_BUCKET = 1_000_000


def _curve(scored: DataFrame, by: Sequence[str], rows_per_bucket: int) -> DataFrame:
    """``scored`` has the columns of ``by``, ``score`` and ``pos`` (0 or 1)."""
    by = list(by)
    grouped = scored.groupBy(*by, "score").agg(
        F.sum("pos").alias("pos"), F.sum(1 - F.col("pos")).alias("neg"))
    grouped = materialize(grouped, "scores")
    ranges = math.ceil(grouped.count() / rows_per_bucket)
    if ranges > 1:
        # Ranges are about equal in distinct scores; their number is kept in the rows, as files
        # may be read in other partitions.
        grouped = materialize(
            grouped.repartitionByRange(ranges, *by, F.desc("score"))
            .withColumn("bucket", F.spark_partition_id()), "ranges")
    else:
        grouped = grouped.withColumn("bucket", F.lit(0))
    totals = grouped.groupBy(*by, "bucket").agg(
        F.sum("pos").alias("b_pos"), F.sum("neg").alias("b_neg"))
    # ``totals`` has one row per range, and one more per curve that begins inside a range.
    curve = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    before = curve.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    none = F.lit(0).cast("bigint")
    offsets = totals.select(
        *by, "bucket",
        F.coalesce(F.sum("b_pos").over(before), none).alias("o_pos"),
        F.coalesce(F.sum("b_neg").over(before), none).alias("o_neg"),
        F.sum("b_pos").over(curve).alias("all_pos"), F.sum("b_neg").over(curve).alias("all_neg"))
    # Within a range of one curve; never more than its ``rows_per_bucket`` or so.
    running = W.partitionBy(*by, "bucket").orderBy(F.desc("score"))
    points = grouped.select(
        *by, "bucket", "score", "pos", "neg",
        F.sum("pos").over(running).alias("in_pos"), F.sum("neg").over(running).alias("in_neg"))
    tp, fp = F.col("in_pos") + F.col("o_pos"), F.col("in_neg") + F.col("o_neg")
    return points.join(offsets, [*by, "bucket"]).select(
        *by, "score", "pos", "neg", tp.alias("tp"), fp.alias("fp"),
        F.try_divide(fp.cast("double"), F.col("all_neg")).alias("fpr"),
        F.try_divide(tp.cast("double"), F.col("all_pos")).alias("tpr"))


def roc_curve(
    df: DataFrame, label: str = "label", score: str = "score",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """False and true positive rate at each distinct score of a binary label (1 is positive).

    The point (0, 0) before the highest score is implied and not listed.
    """
    value = nan_to_null(ref(score), df.schema[score].dataType).cast("double")
    scored = df.select(value.alias("score"), (ref(label) == 1).cast("int").alias("pos"))
    return _curve(scored.where("score is not null and pos is not null"), [], rows_per_bucket)


def roc_curve_ovr(
    df: DataFrame, label: str = "label", probs: str = "probability",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """One curve per class against the rest, from an array of class probabilities."""
    pairs = df.select(ref(label).alias("y"), F.posexplode_outer(ref(probs)).alias("class", "p"))
    scored = pairs.select(
        "class", F.col("p").cast("double").alias("score"),
        (F.col("y") == F.col("class")).cast("int").alias("pos"))
    return _curve(scored.where("score is not null and pos is not null"), ["class"], rows_per_bucket)


def auc(curve: DataFrame) -> DataFrame:
    """Trapezoid area under each curve, as a sum over its points (no ordering needed)."""
    by = ["class"] if "class" in curve.columns else []
    below = F.col("tp").cast("double") - F.col("pos") / F.lit(2.0)
    area = F.try_divide(
        F.sum(F.col("neg") * below), F.max("tp").cast("double") * F.max("fp"))
    return curve.groupBy(*by).agg(area.alias("auc"))


def macro_auc(curve: DataFrame) -> DataFrame:
    """Mean one-vs-rest area over the classes that have both positives and negatives."""
    return auc(curve).agg(F.avg("auc").alias("auc"))
