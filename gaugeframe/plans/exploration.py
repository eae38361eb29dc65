"""The whole profile of a table, as named DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gaugeframe.operators import distribution, profile
from gaugeframe.sources.tables import column_roles


def explore(df: DataFrame, target: str | None = None, exact: bool = True) -> dict[str, DataFrame]:
    """Every profile table that applies, ready for ``write_profile`` (flat columns only)."""
    roles = column_roles(df, target)
    out = {
        "dataset_info": profile.dataset_info(df, target),
        "missing_values_report": profile.missing_profile(df),
        "duplicates_report": profile.duplicate_profile(df),
    }
    if roles.numeric:
        out["numeric_summary"] = profile.numeric_summary(df, roles.numeric, exact)
        out["outliers"] = profile.iqr_bounds(df, roles.numeric, exact=exact)
        out["scaling_advice"] = profile.scaling_advice(df, roles.numeric)
        out["shape_moments"] = profile.shape_moments(df, roles.numeric, "drop")
        out["histograms"] = distribution.histogram(df, roles.numeric)
        out["densities"] = distribution.density_columns(df, roles.numeric)
        out["box_stats"] = distribution.box_stats(df, roles.numeric, exact)
    if len(roles.numeric) > 1:
        corr = distribution.correlation_matrix(df, roles.numeric)
        out["correlation_matrix"] = corr.select("a", "b", "corr")
        out["top_correlations"] = distribution.top_correlations(corr)
        out["correlation_lower_triangle"] = distribution.correlation_lower_triangle(corr)
    if roles.categorical:
        out["categorical_summary"] = profile.categorical_summary(df, roles.categorical)
        out["encoding_advice"] = profile.encoding_advice(df, roles.categorical)
    if roles.target is not None:
        out["target_summary"] = profile.target_summary(df, target)
        out["class_distribution"] = profile.class_distribution(df, target)
        out["imbalance"] = profile.imbalance_ratio(df, target)
    return out
