"""Exact "the r-th smallest hash of a group" without sorting or shuffling the rows.

A reproducible random order over rows is the order of an md5 key. To cut a group at an
exact rank only the key *at* that rank is needed: rows are counted per hash prefix (a few
thousand counters per group), the prefix that contains the rank is kept, and once a prefix
holds few rows those alone are ranked. The caller then compares each row's key with the
cutoff, a narrow projection, so a split of any table costs a few pruned scans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.functions.columns import ref, small_table
from gaugeframe.sources.scratch import materialize

KEY, GROUP = "__gf_key", "__gf_group"
DIGITS = 3
RANKABLE_ROWS = 50_000
_STATE = "grp string, slot int, prefix string, rank bigint, size bigint"


def row_identity(df: DataFrame, key: str | Sequence[str] | None = None) -> Column:
    """Text that identifies a row: one id column as it is, else a digest of the columns."""
    if isinstance(key, str):
        key = [key]
    if key is not None and len(key) == 1:
        return ref(key[0]).cast("string")
    names = list(key) if key is not None else df.columns
    return F.md5(F.concat(*[_exact_text(ref(c), df.schema[c].dataType) for c in names]))


def _exact_text(col: Column, dtype: T.DataType) -> Column:
    """Text that differs whenever the values do, with its length in front; nulls are marked."""
    if isinstance(dtype, T.TimestampType):
        value = F.unix_micros(col).cast("string")
    elif isinstance(dtype, T.BinaryType):
        value = F.hex(col)
    elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        value = F.to_json(F.struct(col), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                                          "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    else:
        value = col.cast("string")
    return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def row_key(df: DataFrame, seed: int, key: str | Sequence[str] | None = None) -> Column:
    """md5 of the seed and the row's identity, the random order of a split."""
    return F.md5(F.concat(F.lit(f"{seed}:"), row_identity(df, key)))


def group_key(col: Column) -> Column:
    """A non-null text form of a label, so that missing labels are a group of their own."""
    return F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit("missing"))


def prefix_counts(keys: DataFrame) -> DataFrame:
    """Stored (GROUP, bucket, n): rows per first digits of the key, combined before the shuffle.

    Group sizes and the first step of the rank search both read it instead of the rows.
    """
    counted = keys.groupBy(GROUP, F.substring(KEY, 1, DIGITS).alias("bucket")).agg(
        F.count("*").alias("n"))
    return materialize(counted, "key-prefixes")


def group_sizes(counts: DataFrame, max_groups: int) -> dict[str, int]:
    sizes = counts.groupBy(GROUP).agg(F.sum("n").alias("n")).limit(max_groups + 1).collect()
    if len(sizes) > max_groups:
        raise ValueError(f"more than {max_groups} groups: this is not a class label")
    return {r[GROUP]: r["n"] for r in sizes}


def cutoffs(
    keys: DataFrame,
    counts: DataFrame,
    sizes: dict[str, int],
    wanted: dict[tuple[str, int], int],
    rankable_rows: int = RANKABLE_ROWS,
) -> dict[tuple[str, int], str]:
    """Key of the given 1-based rank for each (group, slot).

    ``keys`` has the columns KEY and GROUP, ``counts`` is its ``prefix_counts``.
    """
    if not wanted:
        return {}
    spark = keys.sparkSession
    state, depth = [(g, s, "", r, sizes[g]) for (g, s), r in wanted.items()], 0
    if max(sizes.values()) > rankable_rows:
        first = small_table(spark, state, _STATE).drop("size")
        state = _narrowed(counts.join(F.broadcast(first), F.col(GROUP) == F.col("grp")))
        depth = DIGITS
    while depth and max(row[4] for row in state) > rankable_rows and depth < 30:
        counts = (
            _inside(keys, small_table(spark, state, _STATE), depth)
            .withColumn("bucket", F.substring(KEY, 1, depth + DIGITS))
            .groupBy("grp", "slot", "rank", "bucket")
            .agg(F.count("*").alias("n"))
        )
        state, depth = _narrowed(counts), depth + DIGITS

    w = W.partitionBy("grp", "slot").orderBy(KEY)
    found = (
        _inside(keys, small_table(spark, state, _STATE), depth)
        .select("grp", "slot", "rank", KEY, F.row_number().over(w).alias("at"),
                F.lead(KEY).over(w).alias("next"))
        .where(F.col("at") == F.col("rank"))
        .collect()
    )
    if any(r["next"] == r[KEY] for r in found):
        raise ValueError("rows at a cut share one key: pass a unique key or drop duplicates first")
    return {(r["grp"], r["slot"]): r[KEY] for r in found}


def _narrowed(counts: DataFrame) -> list[tuple]:
    """The bucket that holds each rank, with the rank inside it and its size."""
    # At most 16^DIGITS rows per group and slot reach this window.
    running = F.sum("n").over(W.partitionBy("grp", "slot").orderBy("bucket"))
    upto, n, rank = F.col("upto"), F.col("n"), F.col("rank")
    hit = counts.withColumn("upto", running).where((upto >= rank) & (upto - n < rank))
    return [tuple(r) for r in hit.select(
        "grp", "slot", "bucket", (rank - upto + n).alias("rank"), "n").collect()]


def _inside(keys: DataFrame, state: DataFrame, depth: int) -> DataFrame:
    # The state has one row per (group, slot): the classes times two, or the folds. A prefix that is
    # never null keeps Spark from hashing every row once more to filter nulls; "-" is in no prefix.
    prefix = F.coalesce(F.substring(KEY, 1, depth), F.lit("-"))
    return keys.join(
        F.broadcast(state), (F.col(GROUP) == F.col("grp")) & (prefix == F.col("prefix")), "inner")
