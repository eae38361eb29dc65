"""Exact stratified splits and folds: key cutoffs per class, then a narrow projection."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeframe.functions.columns import ref, small_table
from gaugeframe.functions.hashrank import (
    GROUP,
    KEY,
    RANKABLE_ROWS,
    cutoffs,
    group_key,
    group_sizes,
    prefix_counts,
    row_key,
)
from gaugeframe.operators.encode import MAX_CLASSES


def class_quotas(sizes: dict[str, int], draws: int) -> dict[str, int]:
    """Share ``draws`` over the classes: floors, then largest remainders, ties by class order."""
    total = sum(sizes.values())
    order = sorted(sizes)
    quota = {c: sizes[c] * draws // total for c in order}
    left = draws - sum(quota.values())
    by_remainder = sorted(order, key=lambda c: (-(sizes[c] * draws % total), c))
    for c in by_remainder[:left]:
        quota[c] += 1
    return quota


def split_quotas(
    sizes: dict[str, int], test: float, val: float
) -> tuple[dict[str, int], dict[str, int]]:
    """Test rows per class from all rows, then validation rows per class from the rest."""
    n = sum(sizes.values())
    n_test = math.ceil(test * n)
    tests = class_quotas(sizes, n_test)
    rest = {c: sizes[c] - tests[c] for c in sizes}
    n_val = math.ceil(val / (1 - test) * (n - n_test))
    return tests, class_quotas(rest, n_val) if n > n_test else dict.fromkeys(sizes, 0)


def stratified_split(
    df: DataFrame,
    label: str,
    test: float = 0.15,
    val: float = 0.15,
    seed: int = 42,
    key: str | Sequence[str] | None = None,
    rankable_rows: int = RANKABLE_ROWS,
) -> DataFrame:
    """Add ``split`` (train / val / test) with exact per-class quotas.

    Within a class rows are ordered by the md5 of seed and key, so the result does not
    depend on partitioning. ``key`` must be unique; the default is the whole row, which
    needs duplicates dropped first.
    """
    keyed = df.withColumn(KEY, row_key(df, seed, key)).withColumn(GROUP, group_key(ref(label)))
    keys = keyed.select(KEY, GROUP)
    counts = prefix_counts(keys)
    sizes = group_sizes(counts, MAX_CLASSES)
    if not sizes:
        return df.withColumn("split", F.lit(None).cast("string"))
    tests, vals = split_quotas(sizes, test, val)
    wanted = {}
    for c in sizes:
        for slot, rank in ((0, tests[c]), (1, tests[c] + vals[c])):
            if rank:
                wanted[(c, slot)] = rank
    at = cutoffs(keys, counts, sizes, wanted, rankable_rows)
    # One row per class; an empty quota has the cutoff '', below every md5.
    table = small_table(
        df.sparkSession,
        [(c, at.get((c, 0), ""), at.get((c, 1), "")) for c in sizes],
        "__gf_class string, __gf_test string, __gf_val string",
    )
    split = (
        F.when(F.col(KEY) <= F.col("__gf_test"), "test")
        .when(F.col(KEY) <= F.col("__gf_val"), "val")
        .otherwise("train")
    )
    return keyed.join(F.broadcast(table), F.col(GROUP) == F.col("__gf_class")).select(
        *[ref(c) for c in df.columns], split.alias("split"))


def split_report(df: DataFrame, label: str) -> DataFrame:
    """Rows and share of each split, and of each class inside its split."""
    cells = df.groupBy("split", ref(label).alias("class")).agg(F.count("*").alias("n"))
    total = cells.agg(F.sum("n")).scalar()
    # ``cells`` holds one row per split and class.
    sizes = cells.groupBy("split").agg(F.sum("n").alias("split_size"))
    return cells.join(F.broadcast(sizes), "split").select(
        "split", "class", "n", "split_size",
        (F.col("split_size").cast("double") / total * 100).alias("split_percentage"),
        (F.col("n").cast("double") / F.col("split_size") * 100).alias("class_percentage"),
    )


def train_full(df: DataFrame) -> DataFrame:
    """Training and validation rows together, the input of cross-validation."""
    return df.where(F.col("split").isin("train", "val"))


def kfold_assign(
    df: DataFrame,
    k: int = 5,
    seed: int = 42,
    key: str | Sequence[str] | None = None,
    rankable_rows: int = RANKABLE_ROWS,
) -> DataFrame:
    """Add ``fold`` 0..k-1: shuffled, not stratified, the first n mod k folds one row larger."""
    keyed = df.withColumn(KEY, row_key(df, seed, key))
    keys = keyed.select(KEY, F.lit("all").alias(GROUP))
    counts = prefix_counts(keys)
    n = group_sizes(counts, 1).get("all", 0)
    if n < k:
        raise ValueError(f"cannot make {k} folds of {n} rows")
    ends = [sum(n // k + (f < n % k) for f in range(upto + 1)) for upto in range(k - 1)]
    wanted = {("all", i): r for i, r in enumerate(ends)}
    at = cutoffs(keys, counts, {"all": n}, wanted, rankable_rows)
    fold = F.lit(0)
    for i in range(k - 1):
        fold = fold + (F.col(KEY) > F.lit(at[("all", i)])).cast("int")
    return keyed.withColumn("fold", fold).select(*[ref(c) for c in df.columns], "fold")
