"""Cleaning: sparse columns, imputation, duplicates, outlier capping, number parsing.

Every fitted step is ``fit_*`` (a small aggregate) followed by a lazy projection, so it can
be fitted on one part of a table and applied to another.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.functions.columns import canonical, ident, iqr_cap, number, ref, text
from gaugeframe.functions.order_stats import quantiles
from gaugeframe.operators import profile

# Fixed value: the fill for a text column without any value.
UNKNOWN = "Unknown"
MAX_MISSING = 0.30


@dataclass(frozen=True)
class MissingFit:
    """Columns to drop and the value that fills each remaining column with gaps."""

    dropped: list[str] = field(default_factory=list)
    medians: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)


def sparse_columns(
    df: DataFrame, max_missing: float = MAX_MISSING, protect: Sequence[str] = ()
) -> tuple[list[str], list[str]]:
    """(columns above the limit, other columns with at least one null), from one scan."""
    counts = {r["column_name"]: r for r in profile.missing_counts(df).collect()}
    sparse, gaps = [], []
    for c in df.columns:
        missing = counts[c]["missing_count"]
        if not missing:
            continue
        too_many = missing / counts[c]["n_rows"] * 100 > max_missing * 100
        (sparse if too_many and c not in protect else gaps).append(c)
    return sparse, gaps


def drop_sparse_columns(
    df: DataFrame, max_missing: float = MAX_MISSING, protect: Sequence[str] = ()
) -> DataFrame:
    """Drop columns whose missing share is strictly above ``max_missing``."""
    sparse, _ = sparse_columns(df, max_missing, protect)
    return df.select(*[ref(c) for c in df.columns if c not in sparse])


def fit_medians(df: DataFrame, cols: Sequence[str], exact: bool = True) -> dict[str, float]:
    found = quantiles(df, list(cols), (0.5,), exact)
    return {c: m for c, (m,) in found.items() if m is not None}


def fit_modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column as text, smallest on ties."""
    if not cols:
        return {}
    rows = profile.top_levels(profile.level_counts(df, cols)).collect()
    return {r["column_name"]: r["top_category"] for r in rows}


def _fill(df: DataFrame, medians: dict[str, float], modes: dict[str, str]) -> DataFrame:
    df = canonical(df)
    out = []
    for f in df.schema.fields:
        q = ident(f.name)
        if f.name in medians:
            out.append(f"coalesce(CAST({q} AS DOUBLE), {number(medians[f.name])}) AS {q}")
        elif f.name in modes:
            kind = f.dataType.simpleString()
            out.append(f"coalesce({q}, CAST({text(modes[f.name])} AS {kind})) AS {q}")
        else:
            out.append(q)
    return df.selectExpr(*out)


def impute_median(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Numeric nulls become the column's median; the column becomes double."""
    return _fill(df, fit_medians(df, cols, exact), {})


def impute_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Other nulls become the most frequent value, ``'Unknown'`` when there is none."""
    return _fill(df, {}, _modes_or_unknown(df, cols))


def _modes_or_unknown(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    modes = fit_modes(df, cols)
    types = {f.name: f.dataType for f in df.schema.fields}
    return {c: modes.get(c, UNKNOWN) for c in cols
            if c in modes or isinstance(types[c], T.StringType)}


def fit_missing(
    df: DataFrame,
    target: str | None = None,
    impute_target: bool = True,
    max_missing: float = MAX_MISSING,
    exact: bool = True,
    every_column: bool = False,
    untouched: Sequence[str] = (),
) -> MissingFit:
    """Which columns to drop and what to fill; the target is never dropped.

    ``every_column`` also learns a fill for columns without gaps; ``untouched`` columns are
    neither looked at nor dropped nor filled.
    """
    df = df.select(*[ref(c) for c in df.columns if c not in untouched])
    sparse, gaps = sparse_columns(df, max_missing, [target] if target else [])
    if every_column:
        gaps = [c for c in df.columns if c not in sparse]
    if target and not impute_target:
        gaps = [c for c in gaps if c != target]
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in gaps if isinstance(types[c], T.NumericType)]
    text = [c for c in gaps if c not in numeric]
    return MissingFit(sparse, fit_medians(df, numeric, exact), _modes_or_unknown(df, text))


def apply_missing(df: DataFrame, fit: MissingFit) -> DataFrame:
    kept = df.select(*[ref(c) for c in df.columns if c not in fit.dropped])
    return _fill(kept, fit.medians, fit.modes)


def clean_missing(
    df: DataFrame, target: str | None = None, impute_target: bool = True
) -> DataFrame:
    """Drop sparse columns, then fill numbers with medians and the rest with modes."""
    return apply_missing(df, fit_missing(df, target, impute_target))


def drop_duplicates(df: DataFrame, suspect_limit: int = profile.SUSPECT_LIMIT) -> DataFrame:
    """One copy of each full row (null equals null).

    Rows whose 64-bit hash is unique cannot have a copy and pass through unshuffled; only rows
    under a repeated hash are grouped (``profile.split_by_copies``).
    """
    alone, copied = profile.split_by_copies(canonical(df), suspect_limit)
    return alone.unionByName(copied.dropDuplicates())


def fit_caps(
    df: DataFrame,
    cols: Sequence[str],
    k: float = profile.FENCE,
    skip_zero_iqr: bool = False,
    exact: bool = True,
) -> dict[str, tuple[float, float]]:
    fences = profile.iqr_fences(df, cols, k, exact)
    return {c: (f[2], f[3]) for c, f in fences.items()
            if f is not None and not (skip_zero_iqr and f[0] == f[1])}


def apply_caps(df: DataFrame, caps: dict[str, tuple[float, float]]) -> DataFrame:
    df = canonical(df)
    return df.select(*[
        (iqr_cap(ref(c).cast("double"), *caps[c]) if c in caps else ref(c)).alias(c)
        for c in df.columns
    ])


def cap_outliers(
    df: DataFrame,
    cols: Sequence[str],
    k: float = profile.FENCE,
    skip_zero_iqr: bool = False,
    exact: bool = True,
) -> DataFrame:
    """Clip each column to its interquartile fences; nulls stay null."""
    return apply_caps(df, fit_caps(df, cols, k, skip_zero_iqr, exact))


def coerce_numeric(df: DataFrame, cols: Sequence[str] | None = None, fill: float = 0) -> DataFrame:
    """Text columns to numbers, unparsable text to missing, then every missing value filled."""
    df = canonical(df)
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    out = []
    for f in df.schema.fields:
        col = ref(f.name)
        if f.name in cols:
            number = col.try_cast("double")
            col = F.coalesce(F.when(~F.isnan(number), number), F.lit(float(fill)))
        elif isinstance(f.dataType, T.NumericType):
            col = F.coalesce(col, F.lit(fill).cast(f.dataType))
        out.append(col.alias(f.name))
    return df.select(*out)
