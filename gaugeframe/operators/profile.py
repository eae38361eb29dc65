"""Column and table profiles: counts, missing values, duplicates, summaries, advice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.functions.columns import (
    canonical,
    column_stats,
    ident,
    ref,
    small_table,
    tall,
    text,
    unpivoted,
)
from gaugeframe.functions.order_stats import quantiles
from gaugeframe.sources.scratch import materialize
from gaugeframe.sources.tables import column_roles

FENCE = 1.5
QUARTILES = (0.25, 0.5, 0.75)
SUSPECT_LIMIT = 1_000_000
FILTER_BITS, FILTER_WORDS = 16, 1 << 22


def dataset_info(df: DataFrame, target: str | None = None) -> DataFrame:
    """One row per column with its type and role, next to the table's row and column counts."""
    roles = column_roles(df, target)
    role_of = {c: "numeric" for c in roles.numeric}
    role_of |= {c: "categorical" for c in roles.categorical}
    role_of |= {c: "other" for c in roles.other}
    rows = [
        {
            "column_name": text(f.name),
            "dtype": text(f.dataType.simpleString()),
            "role": text("target" if f.name == target else role_of[f.name]),
            "n_rows": "n",
            "n_columns": f"{len(df.columns)}L",
            "n_numeric": f"{len(roles.numeric)}L",
            "n_categorical": f"{len(roles.categorical)}L",
        }
        for f in df.schema.fields
    ]
    return tall(df.selectExpr("count(*) AS n"), rows)


def missing_counts(df: DataFrame) -> DataFrame:
    """(column_name, n_rows, missing_count) for every column, from one scan."""
    cells = [[str(i), f"{ident(c)} IS NULL"] for i, c in enumerate(df.columns)]
    found = unpivoted(canonical(df), cells, ["column_no", "missing"]).groupBy("column_no").agg(
        F.count("*").alias("n"), F.count_if("missing").alias("gaps"))
    names = small_table(df.sparkSession, list(enumerate(df.columns)),
                        "column_no int, column_name string")
    # One row per column.
    return names.join(F.broadcast(found), "column_no", "left").select(
        "column_name", F.coalesce("n", F.lit(0)).alias("n_rows"),
        F.coalesce("gaps", F.lit(0)).alias("missing_count"))


def missing_profile(df: DataFrame) -> DataFrame:
    """Null count and share of rows for every column that has any, most missing first."""
    share = F.try_divide(F.col("missing_count").cast("double"), F.col("n_rows")) * 100
    return (
        missing_counts(df)
        .where(F.col("missing_count") > 0)
        .select("column_name", "missing_count", share.alias("missing_percentage"))
        .orderBy(F.desc("missing_count"), "column_name")
    )


def missing_totals(before: DataFrame, after: DataFrame) -> DataFrame:
    """All nulls in a table before and after cleaning."""

    both = missing_counts(before).withColumn("stage", F.lit("before")).unionByName(
        missing_counts(after).withColumn("stage", F.lit("after")))
    return both.agg(*[
        F.sum(F.when(F.col("stage") == stage, F.col("missing_count"))).alias(f"missing_{stage}")
        for stage in ("before", "after")
    ])


def row_hash(df: DataFrame):
    """64-bit hash of a whole row; equal rows always agree, unequal rows nearly never."""
    return F.xxhash64(*[ref(c) for c in df.columns])


def _filter_mask(hashed: str) -> str:
    """Three of the 64 bits of a word, chosen by the upper bits of a hash."""
    bits = (f"shiftleft(1L, CAST(shiftrightunsigned({hashed}, {at}) & 63 AS INT))"
            for at in (40, 46, 52))
    return " | ".join(bits)


def _repeated_filter(hashes: DataFrame, count: int) -> DataFrame:
    """A Bloom filter of ``hashes``, stored as ``(__gf_word, __gf_bits)``.

    The word is chosen by the lower bits of a hash; there are ``FILTER_BITS`` bits per hash, but
    never more than ``FILTER_WORDS`` words, which is what bounds the broadcast.
    """
    wanted = max(1, count * FILTER_BITS // 64)
    words = min(FILTER_WORDS, 1 << (wanted - 1).bit_length())
    table = hashes.selectExpr(
        f"pmod(__gf_hash, {words}L) AS __gf_word", f"{_filter_mask('__gf_hash')} AS mask"
    ).groupBy("__gf_word").agg(F.bit_or("mask").alias("__gf_bits"))
    return materialize(table.withColumn("__gf_words", F.lit(words).cast("long")), "row-filter")


def split_by_copies(
    df: DataFrame, suspect_limit: int = SUSPECT_LIMIT
) -> tuple[DataFrame, DataFrame]:
    """(rows that surely have no copy, rows that may have one), without moving a row.

    Only an 8-byte hash per row is shuffled, copies collapsed before. Up to ``suspect_limit``
    repeated hashes are broadcast themselves, more as a Bloom filter of bounded size, which lets
    a few rows without a copy pass as suspects.
    """
    hashes = materialize(
        df.select(row_hash(df).alias("__gf_hash")).groupBy("__gf_hash")
        .agg(F.count("*").alias("n")).where("n > 1").select("__gf_hash"), "repeated-rows")
    count = hashes.count()
    if count <= suspect_limit:
        same = row_hash(df) == F.col("__gf_hash")
        return (df.join(F.broadcast(hashes), same, how) for how in ("left_anti", "left_semi"))
    table = _repeated_filter(hashes, count)
    words = table.select("__gf_words").head()[0]
    keys = ", ".join(ident(c) for c in df.columns)
    same = F.expr(f"pmod(xxhash64({keys}), {words}L) = __gf_word AND "
                  f"(__gf_bits & ({_filter_mask(f'xxhash64({keys})')})) = "
                  f"({_filter_mask(f'xxhash64({keys})')})")
    table = table.drop("__gf_words")
    return (df.join(F.broadcast(table), same, how) for how in ("left_anti", "left_semi"))


def duplicate_profile(df: DataFrame, suspect_limit: int = SUSPECT_LIMIT) -> DataFrame:
    """Rows that repeat an earlier identical row (null equals null), with their share."""
    df = canonical(df)
    _, rows = split_by_copies(df, suspect_limit)
    extra = (
        rows.groupBy(*[ref(c) for c in df.columns])
        .agg(F.count("*").alias("__gf_n"))
        .agg(F.coalesce(F.sum(F.col("__gf_n") - 1), F.lit(0)).alias("duplicate_count"))
    )
    zero = F.lit(0).cast("bigint")
    total = df.agg(F.count("*").alias("n_rows"))
    both = extra.select("duplicate_count", zero.alias("n_rows")).unionByName(
        total.select(zero.alias("duplicate_count"), "n_rows"))
    both = both.agg(F.sum("duplicate_count").alias("duplicate_count"),
                    F.sum("n_rows").alias("n_rows"))
    return both.select(
        "duplicate_count",
        F.coalesce(
            F.try_divide(F.col("duplicate_count").cast("double"), F.col("n_rows")) * 100,
            F.lit(0.0),
        ).alias("duplicate_percentage"),
    )


def _moments(nulls: str) -> dict[str, str]:
    ok = "true" if nulls == "drop" else "count(value) = count(*)"
    return {"skewness": f"CASE WHEN {ok} THEN skewness(value) END",
            "kurtosis": f"CASE WHEN {ok} THEN kurtosis(value) END"}


def numeric_summary(
    df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True
) -> DataFrame:
    """count, mean, sample std, min, quartiles, max, skewness and kurtosis per column.

    Skewness and kurtosis are blank for a column with any null, as in ``shape_moments``.
    """
    cols = list(cols) if cols is not None else column_roles(df).numeric
    cuts = quantiles(df, cols, QUARTILES, exact)
    found = column_stats(
        df, cols,
        {"count": "count(value)", "mean": "avg(value)", "std": "stddev_samp(value)",
         "min": "min(value)", "max": "max(value)", **_moments("propagate")},
        {name: [cuts[c][k] for c in cols] for k, name in enumerate(("p25", "p50", "p75"))})
    return found.select(
        "column_name", F.coalesce("count", F.lit(0)).alias("count"), "mean", "std", "min",
        "p25", "p50", "p75", "max", "skewness", "kurtosis")


def shape_moments(
    df: DataFrame, cols: Sequence[str] | None = None, nulls: str = "propagate"
) -> DataFrame:
    """Population skewness and excess kurtosis.

    ``nulls="propagate"`` blanks a column with any null; ``"drop"`` ignores its nulls.
    """
    if nulls not in ("propagate", "drop"):
        raise ValueError("nulls must be 'propagate' or 'drop'")
    cols = list(cols) if cols is not None else column_roles(df).numeric
    return column_stats(df, cols, _moments(nulls))


def level_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, value, n) over the non-null values, all columns in one scan.

    Counts are combined before the shuffle, so a value that holds a third of all rows
    travels once per task.
    """
    tall_form = df.selectExpr(*[f"CAST({ident(c)} AS STRING) AS {ident(c)}" for c in cols]).unpivot(
        [], [ident(c) for c in cols], "column_name", "value"
    )
    return (
        tall_form.where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n"))
    )


def top_levels(levels: DataFrame) -> DataFrame:
    """Distinct count, most frequent value (smallest on ties) and its count per column.

    The counts are compared first, so that only the tied values themselves are ordered.
    """
    sizes = levels.groupBy("column_name").agg(
        F.count("value").alias("unique_count"), F.max("n").alias("top_count"))
    # One row per column.
    best = levels.join(F.broadcast(sizes), "column_name").where(F.col("n") == F.col("top_count"))
    return best.groupBy("column_name", "unique_count", "top_count").agg(
        F.min("value").alias("top_category"))


def categorical_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct non-null values, top value and its count; an all-null column shows 0."""
    cols = list(cols) if cols is not None else column_roles(df).categorical
    found = top_levels(level_counts(df, cols))
    names = small_table(df.sparkSession, [(c,) for c in cols], "column_name string")
    return names.join(found, "column_name", "left").select(
        "column_name",
        F.coalesce("unique_count", F.lit(0)).alias("unique_count"),
        "top_category",
        F.coalesce("top_count", F.lit(0)).alias("top_count"),
    )


def target_summary(df: DataFrame, target: str) -> DataFrame:
    """Class counts of a string target; the numeric description of a numeric one."""
    if isinstance(df.schema[target].dataType, T.NumericType):
        return numeric_summary(df, [target]).drop("skewness", "kurtosis")
    return (
        df.where(ref(target).isNotNull())
        .groupBy(ref(target).cast("string").alias("class"))
        .agg(F.count("*").alias("count"))
    )


def iqr_fences(
    df: DataFrame, cols: Sequence[str], k: float = FENCE, exact: bool = True
) -> dict[str, tuple[float, float, float, float] | None]:
    """(q1, q3, lower, upper) per column; None for a column without values."""
    out = {}
    for c, (q1, q3) in quantiles(df, list(cols), (0.25, 0.75), exact).items():
        out[c] = None if q1 is None else (q1, q3, q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return out


def iqr_bounds(
    df: DataFrame, cols: Sequence[str] | None = None, k: float = FENCE, exact: bool = True
) -> DataFrame:
    """Quartiles, fences and outliers per column, most outliers first."""
    cols = list(cols) if cols is not None else column_roles(df).numeric
    fences = iqr_fences(df, cols, k, exact)
    known = [fences[c] or (None,) * 4 for c in cols]
    found = column_stats(
        df, cols,
        {"n": "count(*)", "outliers": "count_if(value < lower_bound OR value > upper_bound)"},
        {name: [f[at] for f in known] for at, name in enumerate(
            ("q1", "q3", "lower_bound", "upper_bound"))})
    outliers = F.coalesce("outliers", F.lit(0))
    return found.select(
        "column_name", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"), "lower_bound",
        "upper_bound", outliers.alias("outlier_count"),
        (F.try_divide(outliers.cast("double"), F.col("n")) * 100).alias("outlier_percentage"),
    ).orderBy(F.desc("outlier_count"), "column_name")


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """Count and share of all rows per class; missing labels count in the share's base only."""
    by_class = df.groupBy(ref(target).alias("class")).agg(F.count("*").alias("count"))
    total = by_class.agg(F.sum("count")).scalar()
    return (
        by_class.where(F.col("class").isNotNull())
        .select("class", "count", (F.col("count").cast("double") / total * 100)
                .alias("percentage"))
        .orderBy(F.desc("count"), "class")
    )


def imbalance_ratio(df: DataFrame, target: str, threshold: float = 5.0) -> DataFrame:
    """Largest over smallest class, flagged when above ``threshold``."""
    counts = (
        df.where(ref(target).isNotNull()).groupBy(ref(target)).agg(F.count("*").alias("n"))
    )
    ratio = F.try_divide(F.max("n").cast("double"), F.min("n"))
    return counts.agg(
        F.max("n").alias("max_count"), F.min("n").alias("min_count"),
        ratio.alias("imbalance_ratio"), (ratio > threshold).alias("imbalanced"),
    )


def scaling_advice(
    df: DataFrame, cols: Sequence[str] | None = None, wide: float = 100.0
) -> DataFrame:
    """Minimum, maximum and range per column; a range above ``wide`` needs scaling."""
    cols = list(cols) if cols is not None else column_roles(df).numeric
    span = F.col("max") - F.col("min")
    return column_stats(df, cols, {"min": "min(value)", "max": "max(value)"}).select(
        "column_name", "min", "max", span.alias("range"),
        F.coalesce(span > wide, F.lit(False)).alias("needs_scaling"))


def encoding_advice(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Suggested encoding by distinct count: above 10 high, exactly 2 binary, else one-hot."""
    n = F.col("unique_count")
    advice = F.when(n > 10, "high").when(n == 2, "binary").otherwise("one-hot")
    return categorical_summary(df, cols).select("column_name", n, advice.alias("advice"))
