from gaugeframe.functions.columns import canonical, iqr_cap, ref, safe_div
from gaugeframe.functions.hashrank import row_key
from gaugeframe.functions.order_stats import quantiles

__all__ = ["canonical", "iqr_cap", "quantiles", "ref", "row_key", "safe_div"]
