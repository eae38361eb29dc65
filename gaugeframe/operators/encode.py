"""Categorical encoding routed by cardinality, standard scaling, label indexing."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.functions.columns import canonical, column_stats, ident, number, ref, small_table, text
from gaugeframe.operators import profile
from gaugeframe.sources.scratch import materialize
from gaugeframe.sources.tables import column_roles

BINARY = 2
ONE_HOT_MAX = 10
MAX_CLASSES = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 1e-4
LOCAL_LEVELS = 100_000
RANGE_ROWS = 1_000_000  # classes that one task numbers


@dataclass(frozen=True)
class EncodingFit:
    """Which columns take which code, with the small value lists and the share tables."""

    binary: dict[str, list[str]] = field(default_factory=dict)
    one_hot: dict[str, list[str]] = field(default_factory=dict)
    shares: dict[str, "Shares"] = field(default_factory=dict)


@dataclass(frozen=True)
class Shares:
    """A column's (value, share) table, whether it may be broadcast, and its moments.

    The mean and population std are those of the coded column over its non-null rows.
    """

    table: DataFrame
    small: bool
    mean: float
    std: float


def fit_encoding(
    df: DataFrame, cols: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES
) -> EncodingFit:
    """Count the values of all columns in one scan and route each column by its cardinality."""
    if not cols:
        return EncodingFit()
    levels, sizes, known = _levels(df, cols, broadcast_bytes)
    binary, one_hot = {}, {}
    for c in cols:
        n = sizes[c]["levels"] if c in sizes else 0
        if n <= ONE_HOT_MAX:
            values = sorted(known.get(c, {}), key=lambda v: v.encode())
            (binary if n == BINARY else one_hot)[c] = values
    rest = [c for c in cols if c not in binary and c not in one_hot]
    return EncodingFit(binary, one_hot, _shares(levels, sizes, known, rest, broadcast_bytes))


def _levels(df: DataFrame, cols: Sequence[str], broadcast_bytes: int):
    """The stored (column, value, n) table, its size per column, and the small columns' rows."""
    levels = materialize(profile.level_counts(df, cols), "levels", ["column_name"])
    sizes = {
        r["column_name"]: r
        for r in levels.groupBy("column_name")
        .agg(F.count("*").alias("levels"), F.sum("n").alias("total"),
             F.sum(F.octet_length("value") + 32).alias("bytes"),
             F.min("n").alias("least"), F.max("n").alias("most"),
             F.sum(F.pow("n", F.lit(2))).alias("n2"), F.sum(F.pow("n", F.lit(3))).alias("n3"))
        .collect()
    }
    local, room = [], LOCAL_LEVELS
    for c in sorted(sizes, key=lambda c: sizes[c]["levels"]):
        if sizes[c]["levels"] <= ONE_HOT_MAX:
            local.append(c)
        elif sizes[c]["levels"] <= room and sizes[c]["bytes"] <= broadcast_bytes:
            local.append(c)
            room -= sizes[c]["levels"]
    known: dict[str, dict[str, int]] = {c: {} for c in local}
    # At most LOCAL_LEVELS values, and ten per column below that, come to the driver.
    for r in levels.where(F.col("column_name").isin(local)).collect() if local else []:
        known[r["column_name"]][r["value"]] = r["n"]
    return levels, sizes, known


def _shares(levels, sizes, known, cols: Sequence[str], broadcast_bytes: int) -> dict[str, Shares]:
    """Value shares per column; the tables broadcast together stay within the byte limit."""
    out, room = {}, broadcast_bytes
    for c in sorted(cols, key=lambda c: sizes[c]["bytes"]):
        total = sizes[c]["total"]
        if c in known and broadcast_bytes:
            table = small_table(
                levels.sparkSession, [(v, n / total) for v, n in known[c].items()],
                "__gf_value string, __gf_share double")
        else:
            table = levels.where(F.col("column_name") == c).select(
                F.col("value").alias("__gf_value"),
                (F.col("n").cast("double") / F.lit(total)).alias("__gf_share"))
        room -= sizes[c]["bytes"]
        # The coded column holds n / total in n rows, so its moments follow from the counts.
        mean = sizes[c]["n2"] / total**2
        even = sizes[c]["least"] == sizes[c]["most"]
        spread = 0.0 if even else max(sizes[c]["n3"] / total**3 - mean**2, 0.0)
        out[c] = Shares(table, room >= 0, mean, spread**0.5)
    return out


def indicator_names(fit: EncodingFit, columns: Sequence[str]) -> dict[tuple[str, str], str]:
    """Name per (column, value). Spark matches names without case, so a name that would equal
    another one that way ("Sex_male" beside "Sex_Male") is numbered."""
    taken = {c.lower() for c in columns if c not in fit.one_hot}
    names = {}
    for c, values in fit.one_hot.items():
        for v in values[1:]:
            name, copy = f"{c}_{v}", 1
            while name.lower() in taken:
                copy += 1
                name = f"{c}_{v}_{copy}"
            taken.add(name.lower())
            names[c, v] = name
    return names


def apply_encoding(df: DataFrame, fit: EncodingFit) -> DataFrame:
    """Binary and share codes replace their column; indicators are appended at the end."""
    columns, share = df.columns, {}
    for i, (c, s) in enumerate(fit.shares.items()):
        df, share[c] = _with_share(df, columns, c, s, i)
    out = []
    for c in columns:
        q = ident(c)
        if c in share:
            out.append(f"{share[c]} AS {q}")
        elif c in fit.binary:
            first, second = map(text, fit.binary[c])
            # A missing value sorts last and so takes code 2, as does one that was not learned.
            out.append(f"CASE {q} WHEN {first} THEN 0 WHEN {second} THEN 1 ELSE 2 END AS {q}")
        elif c not in fit.one_hot:
            out.append(q)
    for (c, v), name in indicator_names(fit, columns).items():
        out.append(f"{ident(c)} <=> {text(v)} AS {ident(name)}")
    return df.selectExpr(*out)


def _with_share(
    df: DataFrame, columns: Sequence[str], c: str, shares: Shares, i: int
) -> tuple[DataFrame, str]:
    """The table with the value's share joined on, and the SQL that reads it."""
    value, share = f"__gf_value{i}", f"__gf_share{i}"
    table = shares.table.toDF(value, share)
    key = ref(c).cast("string")
    if shares.small:
        return df.join(F.broadcast(table), key == F.col(value), "left"), share
    # Too many values to broadcast. Values above HOT_SHARE number at most 1 / HOT_SHARE, so
    # those are broadcast; only the rest is shuffled, and rows already served (or null) are
    # spread over the shuffle by a salt of their own.
    hot_value, hot_share, need, cold, salt = (
        f"__gf_{x}{i}" for x in ("hot", "hots", "need", "cold", "salt"))
    hot = table.where(F.col(share) > HOT_SHARE).toDF(hot_value, hot_share)
    rest = table.where(F.col(share) <= HOT_SHARE).withColumn(cold, F.lit(True))
    served = df.join(F.broadcast(hot), key == F.col(hot_value), "left").withColumn(
        need, F.col(hot_value).isNull() & ref(c).isNotNull()).withColumn(
            salt, F.monotonically_increasing_id().cast("string"))
    on = (F.col(need) == F.col(cold)) & (
        F.when(F.col(need), key).otherwise(F.col(salt)) == F.col(value))
    return served.join(rest, on, "left"), f"coalesce({hot_share}, {share})"


def _only(df: DataFrame, cols: Sequence[str], kind: str) -> DataFrame:
    fit = fit_encoding(df, cols)
    chosen = {"binary": fit.binary, "one_hot": fit.one_hot, "shares": fit.shares}[kind]
    wrong = [c for c in cols if c not in chosen]
    if wrong:
        raise ValueError(f"columns {wrong} do not have the number of values this code needs")
    return apply_encoding(df, fit)


def encode_binary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Two-valued columns to 0/1 in sorted order; a missing value becomes 2."""
    return _only(df, cols, "binary")


def encode_onehot(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Indicator columns ``col_value`` for every value but the first; null is all false."""
    fit = fit_encoding(df, cols)
    many = list(fit.shares)
    if many:
        raise ValueError(f"columns {many} have more than {ONE_HOT_MAX} values")
    return apply_encoding(df, EncodingFit(one_hot={c: (fit.one_hot | fit.binary)[c] for c in cols}))


def encode_frequency(
    df: DataFrame, cols: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Replace a value by its share among the column's non-null rows; null stays null."""
    levels, sizes, known = _levels(df, cols, broadcast_bytes)
    shares = _shares(levels, sizes, known, [c for c in cols if c in sizes], broadcast_bytes)
    empty = [c for c in cols if c not in shares]
    out = apply_encoding(df, EncodingFit(shares=shares))
    return out.select(*[F.lit(None).cast("double").alias(c) if c in empty else ref(c)
                        for c in out.columns])


def encode_categoricals(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Two values: binary; up to ten: indicators; more: share of rows."""
    cols = list(cols) if cols is not None else column_roles(df).categorical
    return apply_encoding(df, fit_encoding(df, cols))


def fit_scale(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(mean, divisor) per column; the divisor of a constant column is 1."""
    if not cols:
        return {}
    found = column_stats(df, cols, {"mean": "avg(value)", "sd": "stddev_pop(value)"})
    return {r["column_name"]: (r["mean"], r["sd"] or 1.0)
            for r in found.collect() if r["mean"] is not None}


def apply_scale(df: DataFrame, fit: dict[str, tuple[float, float]]) -> DataFrame:
    df = canonical(df)
    return df.selectExpr(*[
        f"({ident(c)} - {number(fit[c][0])}) / {number(fit[c][1])} AS {ident(c)}"
        if c in fit else ident(c) for c in df.columns])


def standard_scale(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Subtract the mean and divide by the population std; boolean columns are left alone."""
    cols = list(cols) if cols is not None else column_roles(df).numeric
    return apply_scale(df, fit_scale(df, cols))


def fit_target(df: DataFrame, target: str) -> list[str] | None:
    """Sorted class names of a text target, None for a numeric one."""
    if isinstance(df.schema[target].dataType, T.NumericType):
        return None
    names = df.where(ref(target).isNotNull()).select(
        ref(target).cast("string").alias("c")).distinct().take(MAX_CLASSES + 1)
    if len(names) > MAX_CLASSES:
        raise ValueError(
            f"target {target!r} has more than {MAX_CLASSES} classes: use class_dictionary")
    return sorted((r["c"] for r in names), key=lambda v: v.encode())


def apply_target(
    df: DataFrame, target: str, classes: list[str] | None, label: str = "label"
) -> DataFrame:
    """Add the class index; a numeric target passes through."""
    if classes is None:
        return df.withColumn(label, ref(target))
    mapping = small_table(
        df.sparkSession, list(enumerate(classes)), f"`{label}` int, __gf_class string")
    return df.join(
        F.broadcast(mapping), ref(target).cast("string") == F.col("__gf_class"), "left"
    ).select(*[ref(c) for c in df.columns], ref(label))


def class_dictionary(df: DataFrame, target: str, rows_per_range: int = RANGE_ROWS) -> DataFrame:
    """``(class, label, n)`` of a text target, stored: its classes numbered from 0 in code-point
    order, and their rows. Null is no class.

    Classes are sorted by ranges; each range numbers its own and adds the sizes of those before, so
    no list of all classes is made anywhere.
    """
    found = materialize(
        df.where(ref(target).isNotNull()).groupBy(ref(target).cast("string").alias("class"))
        .agg(F.count("*").alias("n")), "classes")
    ranges = max(1, math.ceil(found.count() / rows_per_range))
    found = materialize(
        found.repartitionByRange(ranges, "class").withColumn("range", F.spark_partition_id()),
        "class-ranges")
    sizes = found.groupBy("range").agg(F.count("*").alias("size"))
    # One row per range.
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(W.partitionBy("range").orderBy("class")) - 1
    numbered = found.withColumn("place", place).join(offsets, "range")
    return materialize(
        numbered.select("class", (F.col("place") + F.col("offset")).alias("label"), "n"),
        "class-dictionary")


def _looked_up(df: DataFrame, key: Column, table: DataFrame, name: str) -> DataFrame:
    """``df`` with the ``value`` of ``table (entry, value, n)`` whose entry equals ``key``.

    Entries with a share of rows above ``HOT_SHARE`` are at most 1 / HOT_SHARE and are broadcast. Of
    the others only the rows that need one meet them in a shuffle; the rest are spread by a salt.
    """
    total = table.agg(F.sum("n")).first()[0] or 0
    hot = table.where(F.col("n") > HOT_SHARE * total).select(
        F.col("entry").alias("__gf_hot"), F.col("value").alias("__gf_hot_value"))
    rest = table.where(F.col("n") <= HOT_SHARE * total).select(
        F.col("entry").alias("__gf_entry"), F.col("value").alias("__gf_value"),
        F.lit(True).alias("__gf_cold"))
    served = df.withColumn("__gf_key", key)
    served = served.join(F.broadcast(hot), F.col("__gf_key") == F.col("__gf_hot"), "left")
    served = served.withColumn(
        "__gf_need", F.col("__gf_hot").isNull() & F.col("__gf_key").isNotNull()).withColumn(
            "__gf_salt", F.monotonically_increasing_id().cast("string"))
    on = (F.col("__gf_need") == F.col("__gf_cold")) & (
        F.when(F.col("__gf_need"), F.col("__gf_key")).otherwise(F.col("__gf_salt"))
        == F.col("__gf_entry"))
    value = F.coalesce("__gf_hot_value", "__gf_value").alias(name)
    return served.join(rest, on, "left").select(*[ref(c) for c in df.columns if c != name], value)


def encode_target(
    df: DataFrame, target: str, label: str = "label", dictionary: DataFrame | None = None
) -> DataFrame:
    """Text target to its index among the sorted class names.

    The classes are those of ``df``, or those of a ``dictionary`` made by ``class_dictionary``, which
    may have any number of them and is joined by equality; a class that it lacks has no index.
    """
    if dictionary is None:
        return apply_target(df, target, fit_target(df, target), label)
    table = dictionary.select(F.col("class").alias("entry"), F.col("label").alias("value"), "n")
    return _looked_up(df, ref(target).cast("string"), table, label)


def decode_label(
    df: DataFrame, classes: Sequence[str] | DataFrame, index: str = "prediction", out: str = "class"
) -> DataFrame:
    """Class index back to class name; an unknown index becomes null.

    ``classes`` is a list, or a table made by ``class_dictionary``.
    """
    if isinstance(classes, DataFrame):
        table = classes.select(F.col("label").cast("string").alias("entry"),
                               F.col("class").alias("value"), "n")
        return _looked_up(df, ref(index).cast("long").cast("string"), table, out)
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes: use class_dictionary")
    mapping = small_table(
        df.sparkSession, list(enumerate(classes)), f"__gf_index int, `{out}` string")
    return df.join(
        F.broadcast(mapping), ref(index).cast("int") == F.col("__gf_index"), "left"
    ).drop("__gf_index")
