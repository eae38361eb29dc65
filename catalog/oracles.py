"""DuckDB SQL with the same result as each query that SQL can express."""

from __future__ import annotations

from catalog.inputs import sql_input
from gaugeframe.operators import verdict

ORACLES: dict[str, str] = {}


def src(name: str) -> str:
    return f"({sql_input(name)}) {name}"


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


PRICES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CLASSES = ["click", "error", "purchase", "signup", "view"]

# --- sources and sinks

ORACLES["S1_load_table"] = "SELECT event_id, user_id, event_type, value FROM events"
ORACLES["S1_load_csv"] = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
_ROLES = {
    "l_orderkey": "numeric", "l_partkey": "numeric", "l_suppkey": "numeric",
    "l_linenumber": "numeric", "l_quantity": "numeric", "l_extendedprice": "numeric",
    "l_discount": "numeric", "l_tax": "numeric", "l_returnflag": "target",
    "l_linestatus": "categorical", "l_shipdate": "other",
}
ORACLES["S2_column_roles"] = union(
    f"SELECT '{c}' AS column_name, '{r}' AS role, count({c}) AS filled FROM lineitem"
    for c, r in _ROLES.items())


def split_sql(source: str, key: str, label: str, extra: str = "", seed: int = 42) -> str:
    """Exact quotas by largest remainder, rows taken in md5 order within the class."""
    return f"""
WITH keyed AS (SELECT {key} AS k, {label} AS c {extra},
                      md5('{seed}:' || CAST({key} AS VARCHAR)) AS h FROM {source}),
sizes AS (SELECT c, count(*) AS n FROM keyed GROUP BY c),
total AS (SELECT CAST(sum(n) AS BIGINT) AS n, CAST(ceil(15e-2 * sum(n)) AS BIGINT) AS d
          FROM sizes),
base AS (SELECT c, sizes.n AS n, (sizes.n * d) // total.n AS q, (sizes.n * d) % total.n AS r,
                d FROM sizes, total),
tests AS (SELECT c, n, q + CASE WHEN row_number() OVER (ORDER BY r DESC, CAST(c AS VARCHAR))
                 <= d - sum(q) OVER () THEN 1 ELSE 0 END AS t FROM base),
rest AS (SELECT c, t, n - t AS n FROM tests),
total2 AS (SELECT CAST(sum(n) AS BIGINT) AS n,
                  CAST(ceil(15e-2 / (1e0 - 15e-2) * sum(n)) AS BIGINT) AS d FROM rest),
base2 AS (SELECT c, t, (rest.n * d) // total2.n AS q, (rest.n * d) % total2.n AS r, d
          FROM rest, total2),
quota AS (SELECT c, t, q + CASE WHEN row_number() OVER (ORDER BY r DESC, CAST(c AS VARCHAR))
                 <= d - sum(q) OVER () THEN 1 ELSE 0 END AS v FROM base2),
ranked AS (SELECT keyed.*, row_number() OVER (PARTITION BY c ORDER BY h) AS rn FROM keyed),
done AS (SELECT ranked.*, CASE WHEN rn <= t THEN 'test' WHEN rn <= t + v THEN 'val'
                ELSE 'train' END AS split FROM ranked JOIN quota USING (c))
"""


_ORDERS_SPLIT = split_sql("orders", "o_orderkey", "o_orderpriority")
ORACLES["S3_write_splits"] = _ORDERS_SPLIT + (
    "SELECT k AS o_orderkey, c AS o_orderpriority, split FROM done")


def class_metrics_sql(source: str, by: str = "") -> str:
    """CTEs ``cls`` (by, class, support, predicted, hits, precision, recall, f1_score)."""
    lead = f"{by}, " if by else ""
    return f"""
WITH pairs AS (SELECT {lead}label AS t, prediction AS p, count(*) AS n FROM {source}
               GROUP BY ALL),
sides AS (SELECT {lead}t AS class, n AS support, 0 AS predicted,
                 CASE WHEN t = p THEN n ELSE 0 END AS hits FROM pairs
          UNION ALL SELECT {lead}p, 0, n, 0 FROM pairs),
sums AS (SELECT {lead}class, CAST(sum(support) AS BIGINT) AS support,
                CAST(sum(predicted) AS BIGINT) AS predicted, CAST(sum(hits) AS BIGINT) AS hits
         FROM sides GROUP BY ALL),
cls AS (SELECT *, coalesce(hits / nullif(predicted, 0), 0) AS "precision",
               coalesce(hits / nullif(support, 0), 0) AS recall,
               coalesce(2 * hits / nullif(support + predicted, 0), 0) AS f1_score FROM sums)
"""


def weighted(metric: str) -> str:
    return f'coalesce(sum(support * "{metric}") / nullif(sum(support), 0), 0)'


ORACLES["S4_write_metrics"] = class_metrics_sql(src("models"), "model_id") + """
, head AS (SELECT model_id, sum(hits) / sum(support) AS accuracy,
                  CAST(sum(hits) AS BIGINT) AS correct,
                  CAST(sum(support) - sum(hits) AS BIGINT) AS incorrect
           FROM cls GROUP BY model_id)
SELECT model_id, round(accuracy, 6) AS accuracy, correct, incorrect, class,
       round("precision", 6) AS "precision", round(recall, 6) AS recall,
       round(f1_score, 6) AS f1_score, support
FROM cls JOIN head USING (model_id)"""

_GAP_COLS = ["half_price", "no_price", "o_custkey", "o_orderkey", "o_orderpriority",
             "o_orderstatus", "o_totalprice"]
_MISSING = f"""
SELECT * FROM ({union(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, "
    f"round((count(*) - count({c})) * 1e0 / count(*) * 100, 6) AS missing_percentage "
    f"FROM {src('orders_nulls')}" for c in _GAP_COLS)}) u WHERE missing_count > 0"""
_DISTRIBUTION = f"""
SELECT o_orderpriority AS class, count(*) AS count,
       round(count(*) * 1e0 / (SELECT count(*) FROM orders) * 100, 6) AS percentage
FROM {src('orders_nulls')} WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority"""
ORACLES["S5_write_profile"] = f"""
SELECT 'missing' AS part, column_name AS name, missing_count AS count,
       missing_percentage AS percentage FROM ({_MISSING}) m
UNION ALL SELECT 'classes', class, count, percentage FROM ({_DISTRIBUTION}) d"""

# --- projections

ORACLES["P1_split_xy"] = (
    "SELECT p_partkey, p_size, p_retailprice, p_type, p_brand FROM part")
ORACLES["P2_drop_sparse_columns"] = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
FROM {src('orders_nulls')}"""
ORACLES["P3_coerce_numeric"] = f"""
SELECT p_partkey, p_retailprice, coalesce(try_cast(code AS DOUBLE), 0) AS code
FROM {src('part_codes')}"""
ORACLES["P4_cast_model_types"] = "SELECT " + ", ".join(
    f"CAST(CAST({c} AS FLOAT) AS DOUBLE) AS {c}" for c in PRICES) + ", l_linenumber FROM lineitem"
ORACLES["P5_iqr_cap"] = f"""
SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 100000e0
       WHEN o_totalprice > 400000 THEN 400000e0 ELSE o_totalprice END AS capped
FROM {src('orders_nulls')}"""
ORACLES["P6_prob_to_label"] = f"""
SELECT event_id, CAST(list_position([p0, p1, p2, p3, p4], greatest(p0, p1, p2, p3, p4)) - 1
       AS INT) AS prediction FROM {src('probabilities')}"""
ORACLES["P6_prob_to_label_binary"] = (
    "SELECT event_id, CASE WHEN value / (value + 35) > 5e-1 THEN 1 ELSE 0 END AS prediction "
    "FROM events")
ORACLES["P7_prediction_rows"] = f"""
SELECT label AS "true", prediction AS predicted, label = prediction AS correct, count(*) AS n
FROM {src('predictions')} GROUP BY ALL"""
ORACLES["P8_decode_label"] = f"""
SELECT event_id, CASE prediction {' '.join(
    f"WHEN {i} THEN '{c}'" for i, c in enumerate(CLASSES))} END AS class
FROM {src('predictions')}"""

# --- profiling

ORACLES["A1_dataset_info"] = union(
    f"SELECT '{c}' AS column_name, '{d}' AS dtype, '{r}' AS role, count(*) AS n_rows, "
    f"CAST(5 AS BIGINT) AS n_columns, CAST(3 AS BIGINT) AS n_numeric, "
    f"CAST(1 AS BIGINT) AS n_categorical FROM customer"
    for c, d, r in [("c_custkey", "bigint", "numeric"), ("c_name", "string", "categorical"),
                    ("c_nationkey", "int", "numeric"), ("c_acctbal", "double", "numeric"),
                    ("c_mktsegment", "string", "target")])
ORACLES["A2_missing_profile"] = _MISSING
ORACLES["A3_duplicate_profile"] = f"""
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_count,
       round(sum(n - 1) * 1e0 / sum(n) * 100, 6) AS duplicate_percentage
FROM (SELECT count(*) AS n FROM {src('orders_dups')}
      GROUP BY o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority) g"""

ORACLES["A3_duplicate_profile_filtered"] = ORACLES["A3_duplicate_profile"]


def describe(table: str, col: str, digits: int) -> str:
    x = f"CAST({col} AS DOUBLE)"
    quarters = ", ".join(f"round(quantile_cont({x}, {q}), {digits}) AS {n}"
                         for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")))
    return (f"SELECT '{col}' AS column_name, count({col}) AS count, "
            f"round(avg({x}), {digits}) AS mean, round(stddev_samp({x}), {digits}) AS std, "
            f"round(min({x}), {digits}) AS min, {quarters}, round(max({x}), {digits}) AS max "
            f"FROM {table}")


ORACLES["A4_numeric_summary"] = union(
    describe("lineitem", c, 5) for c in [*PRICES, "l_linenumber"])

ORACLES["A4_quartiles_wide"] = union(
    f"SELECT '{c}' AS column_name, count({c}) AS count, round(min(CAST({c} AS DOUBLE)), 5) AS min, "
    + ", ".join(f"round(quantile_cont(CAST({c} AS DOUBLE), {q}), 5) AS {n}"
                for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")))
    + f", round(max(CAST({c} AS DOUBLE)), 5) AS max FROM {src('lineitem_wide')}"
    for c in [f"x{i}" for i in range(1, 23)])


def shape(col: str, drop: bool) -> str:
    x, ok = f"CAST({col} AS DOUBLE)", "TRUE" if drop else f"count({col}) = count(*)"
    return f"""
SELECT '{col}' AS column_name,
       CASE WHEN {ok} THEN round(avg(pow(x - m, 3)) / pow(sqrt(avg(pow(x - m, 2))), 3), 6) END
           AS skewness,
       CASE WHEN {ok} THEN round(avg(pow(x - m, 4)) / pow(avg(pow(x - m, 2)), 2) - 3, 6) END
           AS kurtosis
FROM (SELECT {col}, {x} AS x, avg({x}) OVER () AS m FROM {src('orders_nulls')}) s"""


ORACLES["A5_shape_moments"] = union(
    shape(c, False) for c in ["o_custkey", "o_totalprice", "no_price"])
ORACLES["A5_shape_moments_drop"] = union(
    shape(c, True) for c in ["o_custkey", "o_totalprice", "half_price"])


def levels(col: str) -> str:
    return f"""
SELECT '{col}' AS column_name, count(*) AS unique_count,
       first(v ORDER BY n DESC, v) AS top_category, max(n) AS top_count
FROM (SELECT {col} AS v, count(*) AS n FROM {src('part_cat')} WHERE {col} IS NOT NULL
      GROUP BY {col}) g"""


_PART_TEXT = ["p_type", "p_brand", "size_class"]
ORACLES["A6_categorical_summary"] = union(levels(c) for c in _PART_TEXT)
ORACLES["A7_target_summary"] = (
    "SELECT c_mktsegment AS class, count(*) AS count FROM customer GROUP BY c_mktsegment")
ORACLES["A7_target_summary_numeric"] = describe("customer", "c_acctbal", 5)


def fences(table: str, col: str, keep: str = "") -> str:
    """(x, q1, med, q3, lo, hi) per row of a table."""
    x = f"CAST({col} AS DOUBLE)"
    return f"""(SELECT {keep} x, q1, med, q3, q1 - 15e-1 * (q3 - q1) AS lo,
       q3 + 15e-1 * (q3 - q1) AS hi
FROM (SELECT {keep} {x} AS x FROM {table}) a,
     (SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS med,
             quantile_cont({x}, 0.75) AS q3 FROM {table}) b) f"""


ORACLES["A8_iqr_bounds"] = union(
    f"""SELECT '{c}' AS column_name, round(any_value(q1), 6) AS q1, round(any_value(q3), 6) AS q3,
round(any_value(q3 - q1), 6) AS iqr, round(any_value(lo), 6) AS lower_bound,
round(any_value(hi), 6) AS upper_bound, count(*) FILTER (x < lo OR x > hi) AS outlier_count,
round(count(*) FILTER (x < lo OR x > hi) * 1e0 / count(*) * 100, 6) AS outlier_percentage
FROM {fences('events', c)}""" for c in ["value", "user_id"])
ORACLES["A9_class_distribution"] = _DISTRIBUTION
ORACLES["A10_imbalance_ratio"] = """
SELECT max(n) AS max_count, min(n) AS min_count, round(max(n) * 1e0 / min(n), 6)
       AS imbalance_ratio, max(n) * 1e0 / min(n) > 5 AS imbalanced
FROM (SELECT count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang) g"""


def correlations(source: str, cols: list[str]) -> str:
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            r = (f"CASE WHEN stddev_pop({a}) > 0 THEN 1e0 END" if a == b else
                 f"CASE WHEN NOT isnan(corr({a}, {b})) THEN corr({a}, {b}) END")
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {r} AS corr, {i} AS i, {j} AS j "
                         f"FROM {source}")
    return union(parts)


_CORR = correlations(src("lineitem_const"), [*PRICES, "k"])
ORACLES["A11_correlation_matrix"] = f"SELECT a, b, round(corr, 6) AS corr FROM ({_CORR}) c"
ORACLES["A11_correlation_pairwise"] = "SELECT a, b, round(corr, 6) AS corr FROM (" + correlations(
    src("orders_nulls"),
    ["o_orderkey", "o_custkey", "o_totalprice", "half_price", "no_price"]) + ") c"
ORACLES["A11_correlation_wide"] = "SELECT a, b, round(corr, 6) AS corr FROM (" + correlations(
    src("lineitem_wide"), [f"x{i}" for i in range(1, 23) if i not in (16, 17)]) + ") c"
ORACLES["A12_top_correlations"] = f"""
SELECT a, b, round(corr, 6) AS corr FROM ({_CORR}) c WHERE corr <> 1
ORDER BY abs(corr) DESC, a, b LIMIT 20"""
ORACLES["A13_correlation_lower_triangle"] = (
    f"SELECT a, b, round(corr, 6) AS corr FROM ({_CORR}) c WHERE i > j")


def bins(col: str) -> str:
    return f"""
SELECT '{col}' AS column_name, CAST(b AS INT) AS bin,
       round(lo + (hi - lo) * (b - 1) / 30, 6) AS bin_start,
       round(lo + (hi - lo) * b / 30, 6) AS bin_end, count(x) AS count
FROM (SELECT CASE WHEN max({col}) > min({col}) THEN min({col}) ELSE min({col}) - 5e-1 END AS lo,
             CASE WHEN max({col}) > min({col}) THEN max({col}) ELSE max({col}) + 5e-1 END AS hi
      FROM {src('lineitem_const')}) r
CROSS JOIN generate_series(1, 30) g(b)
LEFT JOIN (SELECT {col} AS x FROM {src('lineitem_const')}) v
  ON least(CAST(floor((x - lo) / (hi - lo) * 30) AS BIGINT) + 1, 30) = b
GROUP BY b, lo, hi"""


ORACLES["A14_histogram"] = union(bins(c) for c in ["l_extendedprice", "l_quantity", "k"])
ORACLES["A15_density"] = """
WITH s AS (SELECT count(value) AS n, stddev_samp(value) * pow(count(value), -2e-1) AS w,
                  min(value) - 3 * stddev_samp(value) * pow(count(value), -2e-1) AS lo,
                  max(value) + 3 * stddev_samp(value) * pow(count(value), -2e-1) AS hi
           FROM events),
g AS (SELECT CAST(p AS INT) AS point, lo + p * (hi - lo) / 199 AS x, n, w
      FROM s, generate_series(0, 199) t(p)),
v AS (SELECT value, count(*) AS c FROM events GROUP BY value)
SELECT point, round(x, 8) AS x,
       round(sum(c * exp(-5e-1 * pow((x - value) / w, 2))) / (n * w * sqrt(2 * pi())), 8)
           AS density
FROM g, v GROUP BY point, x, n, w"""
ORACLES["A15_density_columns"] = f"""
WITH v AS ({union(f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS x FROM lineitem"
                  for c in [*PRICES, "l_partkey"])}),
s AS (SELECT column_name, count(x) AS n, stddev_samp(x) * pow(count(x), -2e-1) AS w,
             min(x) AS low, max(x) AS high FROM v GROUP BY column_name),
g AS (SELECT *, low - 3 * w AS lo, (high - low + 6 * w) / 199 AS step, w / 8 AS bin FROM s),
b AS (SELECT column_name, floor((x - lo) / bin) AS edge, count(*) AS n,
             sum((x - lo) / bin - floor((x - lo) / bin)) AS upper
      FROM v JOIN g USING (column_name) GROUP BY ALL),
e AS (SELECT column_name, edge, n - upper AS weight FROM b
      UNION ALL SELECT column_name, edge + 1, upper FROM b),
t AS (SELECT column_name, CAST(p AS INT) AS point, lo + p * step AS x, lo, bin, w, n
      FROM g, generate_series(0, 199) q(p))
SELECT column_name, point, round(x, 9) AS x,
       round(sum(weight * exp(-5e-1 * pow((x - lo - edge * bin) / w, 2)))
             / any_value(n * w * sqrt(2 * pi())), 9) AS density
FROM t JOIN e USING (column_name) GROUP BY column_name, point, x"""
ORACLES["A16_box_stats"] = union(
    f"""SELECT '{c}' AS column_name, round(any_value(q1), 6) AS q1,
round(any_value(med), 6) AS median, round(any_value(q3), 6) AS q3,
round(least(min(x) FILTER (x >= lo AND x <= hi), any_value(q1)), 6) AS whisker_low,
round(greatest(max(x) FILTER (x >= lo AND x <= hi), any_value(q3)), 6) AS whisker_high,
count(*) FILTER (x < lo OR x > hi) AS outlier_count
FROM {fences('events', c)}""" for c in ["value", "user_id"])
ORACLES["A17_scaling_advice"] = union(
    # Adding zero keeps a file's statistics, where a minimum of zero is -0, out of the result.
    f'SELECT \'{c}\' AS column_name, round(min({c} + 0e0), 6) AS "min", '
    f'round(max({c}), 6) AS "max", '
    f'round(max({c}) - min({c}), 6) AS "range", max({c}) - min({c}) > 100 AS needs_scaling '
    f"FROM lineitem" for c in PRICES)
ORACLES["A18_encoding_advice"] = f"""
SELECT column_name, unique_count, CASE WHEN unique_count > 10 THEN 'high'
       WHEN unique_count = 2 THEN 'binary' ELSE 'one-hot' END AS advice
FROM ({ORACLES['A6_categorical_summary']}) s"""
ORACLES["A19_missing_totals"] = f"""
SELECT CAST(sum(missing_count) AS BIGINT) AS missing_before, CAST(0 AS BIGINT) AS missing_after
FROM ({_MISSING}) m"""

# --- cleaning


def median(col: str) -> str:
    return f"(SELECT median({col}) FROM {src('orders_nulls')})"


_MODE = f"""(SELECT o_orderpriority FROM {src('orders_nulls')} WHERE o_orderpriority IS NOT NULL
 GROUP BY o_orderpriority ORDER BY count(*) DESC, o_orderpriority LIMIT 1)"""
ORACLES["T1_impute_median"] = f"""
SELECT o_orderkey, round(coalesce(o_totalprice, {median('o_totalprice')}), 6) AS o_totalprice,
       round(coalesce(half_price, {median('half_price')}), 6) AS half_price
FROM {src('orders_nulls')}"""
ORACLES["T2_impute_mode"] = f"""
SELECT o_orderkey, coalesce(o_orderpriority, {_MODE}) AS o_orderpriority
FROM {src('orders_nulls')}"""
_CLEAN = f"""
SELECT o_orderkey, o_custkey, o_orderstatus,
       coalesce(o_totalprice, {median('o_totalprice')}) AS o_totalprice,
       coalesce(o_orderpriority, {_MODE}) AS o_orderpriority
FROM {src('orders_nulls')}"""
ORACLES["T3_clean_missing"] = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice,
       o_orderpriority FROM ({_CLEAN}) c"""
ORACLES["T4_drop_duplicates"] = f"SELECT DISTINCT * FROM {src('orders_dups')}"
ORACLES["T4_drop_duplicates_filtered"] = ORACLES["T4_drop_duplicates"]
ORACLES["T5_cap_outliers"] = f"""
SELECT event_id, round(greatest(lo, least(hi, x)), 6) AS value
FROM {fences('events', 'value', 'event_id,')}"""
ORACLES["T5_cap_zero_iqr"] = f"""
SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice, greatest(lo, least(hi, x)) AS hits
FROM {fences(src('sparse_count'), 'hits', 'o_orderkey, o_totalprice,')}"""
ORACLES["T6_encode_binary"] = f"""
SELECT p_partkey, CASE size_class WHEN 'big' THEN 0 ELSE 1 END AS size_class
FROM {src('part_cat')}"""
_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
_INDICATORS = ", ".join(f'CAST(p_type = \'{v}\' AS INT) AS "p_type_{v}"' for v in _TYPES[1:])
_BRAND_SHARE = ("round(count(*) OVER (PARTITION BY p_brand) * 1e0 / count(*) OVER (), 6) "
                "AS p_brand")
ORACLES["T7_encode_onehot"] = f"SELECT p_partkey, {_INDICATORS} FROM {src('part_cat')}"
ORACLES["T8_encode_frequency"] = f"SELECT p_partkey, {_BRAND_SHARE} FROM {src('part_cat')}"
ORACLES["T8_encode_frequency_shuffled"] = ORACLES["T8_encode_frequency"]
ORACLES["T8_encode_frequency_cold"] = """
SELECT l_linenumber, round(count(*) OVER (PARTITION BY l_orderkey) * 1e0 / count(*) OVER (), 9) AS k
FROM lineitem"""
ORACLES["T9_encode_categoricals"] = f"""
SELECT p_partkey, p_size, round(p_retailprice, 6) AS p_retailprice, {_BRAND_SHARE},
       CASE size_class WHEN 'big' THEN 0 ELSE 1 END AS size_class, {_INDICATORS}
FROM {src('part_cat')}"""


def scaled(col: str, digits: int = 6) -> str:
    x = f"CAST({col} AS DOUBLE)"
    return (f"round(({x} - avg({x}) OVER ()) / CASE WHEN stddev_pop({x}) OVER () = 0 THEN 1 "
            f"ELSE stddev_pop({x}) OVER () END, {digits}) AS {col}")


ORACLES["T10_standard_scale"] = f"""
SELECT round(l_extendedprice, 6) AS price, {', '.join(
    scaled(c) for c in ['l_quantity', 'l_extendedprice', 'k'])}
FROM {src('lineitem_const')}"""
ORACLES["T11_encode_target"] = """
SELECT c_custkey, c_mktsegment, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INT)
       AS label FROM customer"""
ORACLES["T11_encode_dictionary"] = """
SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS BIGINT) AS label,
       c_name AS name FROM customer"""
_CAPPED = f"""
SELECT o_orderkey, o_orderstatus, o_orderpriority,
       greatest(c1 - 15e-1 * (c3 - c1), least(c3 + 15e-1 * (c3 - c1), o_custkey)) AS o_custkey,
       greatest(t1 - 15e-1 * (t3 - t1), least(t3 + 15e-1 * (t3 - t1), o_totalprice))
           AS o_totalprice
FROM ({_CLEAN}) a, (SELECT quantile_cont(CAST(o_custkey AS DOUBLE), 0.25) AS c1,
                           quantile_cont(CAST(o_custkey AS DOUBLE), 0.75) AS c3,
                           quantile_cont(o_totalprice, 0.25) AS t1,
                           quantile_cont(o_totalprice, 0.75) AS t3 FROM ({_CLEAN}) b) q"""
ORACLES["T12_prepare"] = split_sql(
    f"({_CAPPED}) s", "o_orderkey", "dense_rank() OVER (ORDER BY o_orderpriority) - 1",
    ", o_custkey, o_totalprice, o_orderstatus") + f"""
SELECT k AS o_orderkey, {scaled('o_custkey')}, {scaled('o_totalprice')},
       CAST(o_orderstatus = 'O' AS INT) AS "o_orderstatus_O",
       CAST(o_orderstatus = 'P' AS INT) AS "o_orderstatus_P",
       CAST(c AS INT) AS label, split FROM done"""

ORACLES["T12_transform_stored"] = ORACLES["T12_prepare"].replace(", split FROM done", " FROM done")


def scaled_on_train(col: str) -> str:
    return (f"round(({col} - avg({col}) FILTER (WHERE split = 'train') OVER ()) / "
            f"stddev_pop({col}) FILTER (WHERE split = 'train') OVER (), 6) AS {col}")


_LABELLED = f"""(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       coalesce(o_orderpriority, {_MODE}) AS o_orderpriority FROM {src('orders_nulls')}) s"""
ORACLES["T12_prepare_on_train"] = split_sql(
    _LABELLED, "o_orderkey", "dense_rank() OVER (ORDER BY o_orderpriority) - 1",
    ", o_custkey, o_totalprice, o_orderstatus") + f"""
, filled AS (SELECT k, c, split, o_orderstatus, CAST(o_custkey AS DOUBLE) AS o_custkey,
       coalesce(o_totalprice, (SELECT median(o_totalprice) FROM done WHERE split = 'train'))
           AS o_totalprice FROM done),
cuts AS (SELECT quantile_cont(o_custkey, 0.25) AS c1, quantile_cont(o_custkey, 0.75) AS c3,
                quantile_cont(o_totalprice, 0.25) AS t1, quantile_cont(o_totalprice, 0.75) AS t3
         FROM filled WHERE split = 'train'),
capped AS (SELECT k, c, split, o_orderstatus,
       greatest(c1 - 15e-1 * (c3 - c1), least(c3 + 15e-1 * (c3 - c1), o_custkey)) AS o_custkey,
       greatest(t1 - 15e-1 * (t3 - t1), least(t3 + 15e-1 * (t3 - t1), o_totalprice))
           AS o_totalprice FROM filled, cuts)
SELECT k AS o_orderkey, {scaled_on_train('o_custkey')}, {scaled_on_train('o_totalprice')},
       CAST(o_orderstatus = 'O' AS INT) AS "o_orderstatus_O",
       CAST(o_orderstatus = 'P' AS INT) AS "o_orderstatus_P",
       CAST(c AS INT) AS label, split FROM capped"""

# --- splits

ORACLES["D1_stratified_split"] = ORACLES["S3_write_splits"]
ORACLES["D1_stratified_split_narrowed"] = ORACLES["D1_stratified_split"]
ORACLES["D1_stratified_split_imbalanced"] = split_sql(
    "labels", "doc_id", "quality", ", toxic") + (
    "SELECT k AS doc_id, c AS quality, toxic, split FROM done")
ORACLES["D2_split_report"] = _ORDERS_SPLIT + """
, cells AS (SELECT split, c AS class, count(*) AS n FROM done GROUP BY ALL),
totals AS (SELECT split, CAST(sum(n) AS BIGINT) AS split_size FROM cells GROUP BY split)
SELECT split, class, n, split_size,
       round(split_size * 1e0 / (SELECT count(*) FROM orders) * 100, 6) AS split_percentage,
       round(n * 1e0 / split_size * 100, 6) AS class_percentage
FROM cells JOIN totals USING (split)"""
ORACLES["D3_train_full"] = ORACLES["D1_stratified_split"] + " WHERE split <> 'test'"
ORACLES["D4_kfold_assign"] = """
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('42:' || o_orderkey)) - 1 AS rn,
                  count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CAST(CASE WHEN rn < (n % 5) * (n // 5 + 1) THEN rn // (n // 5 + 1)
       ELSE n % 5 + (rn - (n % 5) * (n // 5 + 1)) // (n // 5) END AS INT) AS fold FROM r"""

ORACLES["D4_kfold_assign_narrowed"] = ORACLES["D4_kfold_assign"]

# --- models: a saturated logistic fit gives the class shares of each group

_CODED = """
WITH o AS (SELECT o_orderkey, o_orderstatus,
                  CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INT) AS c FROM orders),
cells AS (SELECT o_orderstatus, c, count(*) AS n FROM o GROUP BY ALL)
"""
ORACLES["M5_predict_saturated"] = _CODED + "SELECT o_orderstatus, c AS class, n FROM cells"
ORACLES["S6_reload_saturated"] = ORACLES["M5_predict_saturated"]
ORACLES["M1_fit_saturated"] = _CODED + """
SELECT o_orderstatus, CAST(sum(n) AS BIGINT) AS n, max(n) AS hits FROM cells GROUP BY o_orderstatus"""
ORACLES["M6_cross_validate_saturated"] = f"""
WITH o AS (SELECT o_orderkey, o_orderstatus AS g, CASE WHEN o_orderpriority = '5-LOW' THEN 'X'
                  ELSE o_orderstatus END AS c FROM orders),
f AS ({ORACLES["D4_kfold_assign"]}),
parts AS (SELECT fold, g, c, count(*) AS n FROM o JOIN f USING (o_orderkey) GROUP BY ALL),
rest AS (SELECT k.fold AS held, p.g, p.c, sum(p.n) AS n
         FROM parts p JOIN (SELECT DISTINCT fold FROM parts) k ON p.fold <> k.fold GROUP BY ALL),
guess AS (SELECT held AS fold, g, arg_max(c, n) AS c FROM rest GROUP BY ALL)
SELECT fold, round(sum(CASE WHEN guess.c = parts.c THEN n ELSE 0 END) / sum(n), 6) AS accuracy,
       round(sum(CASE WHEN guess.c = parts.c THEN n ELSE 0 END) / sum(n), 6) AS recall
FROM parts JOIN guess USING (fold, g) GROUP BY fold"""

# --- training histories

ORACLES["M3_training_summary"] = f"""
WITH h AS (SELECT * FROM {src('history')}),
best AS (
  SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY val_loss, epoch) AS by_loss,
         row_number() OVER (PARTITION BY run_id ORDER BY val_accuracy DESC, epoch) AS by_acc,
         row_number() OVER (PARTITION BY run_id ORDER BY epoch DESC) AS by_end,
         row_number() OVER (PARTITION BY run_id ORDER BY epoch) AS by_start FROM h),
s AS (SELECT run_id, count(*) AS total_epochs,
       max(epoch) FILTER (by_loss = 1) AS best_epoch_by_val_loss,
       max(epoch) FILTER (by_acc = 1) AS best_epoch_by_val_accuracy,
       max(loss) FILTER (by_end = 1) AS final_training_loss,
       max(accuracy) FILTER (by_end = 1) AS final_training_accuracy,
       max(val_loss) FILTER (by_end = 1) AS final_validation_loss,
       max(val_accuracy) FILTER (by_end = 1) AS final_validation_accuracy,
       min(val_loss) AS best_validation_loss, max(val_accuracy) AS best_validation_accuracy,
       count(*) < 30 AS early_stopping_triggered,
       max(lr) FILTER (by_start = 1) AS initial_lr, max(lr) FILTER (by_end = 1) AS final_lr,
       min(lr) <> max(lr) AS lr_reduced FROM best GROUP BY run_id)
SELECT run_id, total_epochs, best_epoch_by_val_loss, best_epoch_by_val_accuracy,
       {', '.join(f'round({c}, 6) AS {c}' for c in [
           'final_training_loss', 'final_training_accuracy', 'final_validation_loss',
           'final_validation_accuracy', 'best_validation_loss', 'best_validation_accuracy',
           'initial_lr', 'final_lr'])},
       round(final_training_loss - final_validation_loss, 6) AS loss_gap,
       round(final_validation_accuracy - final_training_accuracy, 6) AS accuracy_gap,
       early_stopping_triggered, lr_reduced FROM s"""
ORACLES["M4_loss_gap"] = f"""
SELECT run_id, epoch, round(loss - val_loss, 6) AS loss_gap,
       CASE WHEN loss - val_loss > 0 THEN 'train > val' WHEN loss - val_loss < 0
            THEN 'val > train' ELSE 'equal' END AS larger FROM {src('history')}"""
_FOLDS = class_metrics_sql(src("models"), "model_id, fold") + f"""
, folds AS (SELECT model_id, fold, sum(hits) / sum(support) AS accuracy,
                   {weighted('precision')} AS "precision", {weighted('recall')} AS recall,
                   {weighted('f1_score')} AS f1 FROM cls GROUP BY model_id, fold)
, cv AS (SELECT model_id, count(*) AS n_folds, {', '.join(
    f'avg("{m}") AS mean_{m}, stddev_pop("{m}") AS std_{m}, min("{m}") AS min_{m}, '
    f'max("{m}") AS max_{m}' for m in ['accuracy', 'precision', 'recall', 'f1'])}
  FROM folds GROUP BY model_id)
"""
ORACLES["M7_cv_summary"] = _FOLDS + "SELECT model_id, n_folds, " + ", ".join(
    f"round({s}_{m}, 6) AS {s}_{m}" for m in ["accuracy", "precision", "recall", "f1"]
    for s in ["mean", "std", "min", "max"]) + " FROM cv"

# --- evaluation

_GRID = f"""
WITH l AS (SELECT label AS c FROM {src('predictions')} UNION SELECT prediction
           FROM {src('predictions')}),
cm AS (SELECT a.c AS t, b.c AS p, count(q.event_id) AS n FROM l a CROSS JOIN l b
       LEFT JOIN {src('predictions')} AS q ON q.label = a.c AND q.prediction = b.c
       GROUP BY a.c, b.c)
""".replace(") predictions AS q", ") q")
ORACLES["E1_confusion_matrix"] = _GRID + "SELECT t, p, n FROM cm"
ORACLES["E2_accuracy"] = f"""
SELECT round(avg(CASE WHEN label = prediction THEN 1e0 ELSE 0e0 END), 6) AS accuracy
FROM {src('predictions')}"""
_GAP = class_metrics_sql(src("predictions_gap"))
ORACLES["E3_weighted_prf"] = _GAP + f"""
SELECT round({weighted('precision')}, 6) AS "precision", round({weighted('recall')}, 6) AS recall,
       round({weighted('f1_score')}, 6) AS f1 FROM cls"""
_PRF = 'round("precision", 6) AS "precision", round(recall, 6) AS recall, ' \
       "round(f1_score, 6) AS f1_score"
ORACLES["E4_per_class_metrics"] = _GAP + f"SELECT class, {_PRF}, support FROM cls"
ORACLES["E5_classification_report"] = _GAP + f"""
SELECT CAST(class AS VARCHAR) AS name, {_PRF}, support FROM cls
UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6),
       round(sum(hits) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM cls
UNION ALL SELECT 'macro avg', round(avg("precision"), 6), round(avg(recall), 6),
       round(avg(f1_score), 6), CAST(sum(support) AS BIGINT) FROM cls
UNION ALL SELECT 'weighted avg', round({weighted('precision')}, 6),
       round({weighted('recall')}, 6), round({weighted('f1_score')}, 6),
       CAST(sum(support) AS BIGINT) FROM cls"""
ORACLES["E6_confusion_normalized"] = _GRID + """
SELECT t, p, round(coalesce(n / nullif(sum(n) OVER (PARTITION BY t), 0), 0), 6) AS share
FROM cm"""
ORACLES["E7_error_matrix"] = _GRID + """
, e AS (SELECT t, p, CASE WHEN t = p THEN 0 ELSE n END AS n FROM cm)
SELECT t, p, round(coalesce(n / nullif(sum(n) OVER (PARTITION BY t), 0), 0), 6) AS share
FROM e"""
ORACLES["E1_confusion_cells"] = ORACLES["E1_confusion_matrix"] + " WHERE n > 0"
ORACLES["E6_confusion_shares"] = _GRID + """
SELECT t, p, round(n / sum(n) OVER (PARTITION BY t), 6) AS share FROM cm WHERE n > 0"""
ORACLES["E7_error_shares"] = _GRID + """
SELECT t, p, round(n / sum(n) OVER (PARTITION BY t), 6) AS share FROM cm WHERE n > 0 AND t <> p"""
ORACLES["E8_top_error"] = _GRID + """
, w AS (SELECT * FROM cm WHERE t <> p ORDER BY n DESC, t, p LIMIT 1)
SELECT CAST(sum(cm.n) AS BIGINT) AS total,
       CAST(sum(cm.n) FILTER (cm.t = cm.p) AS BIGINT) AS correct,
       CAST(sum(cm.n) FILTER (cm.t <> cm.p) AS BIGINT) AS incorrect,
       round(sum(cm.n) FILTER (cm.t = cm.p) / sum(cm.n), 6) AS accuracy,
       any_value(w.t) AS error_true, any_value(w.p) AS error_predicted,
       any_value(w.n) AS error_count FROM cm, w"""
ORACLES["E9_prediction_distribution"] = f"""
SELECT CASE WHEN label = prediction THEN 'correct' ELSE 'incorrect' END AS outcome,
       count(*) AS count, round(count(*) * 1e0 / sum(count(*)) OVER () * 100, 6) AS percentage
FROM {src('predictions')} GROUP BY ALL"""
ORACLES["E10_class_accuracy_band"] = f"""
SELECT class, round(accuracy, 6) AS accuracy, CASE WHEN accuracy > 7e-1 THEN 'green'
       WHEN accuracy > 5e-1 THEN 'orange' ELSE 'red' END AS band
FROM (SELECT label AS class, avg(CASE WHEN label = prediction THEN 1e0 ELSE 0e0 END) AS accuracy
      FROM {src('predictions')} GROUP BY label) g"""


def curve_sql(scored: str, by: str = "") -> str:
    """CTE ``curve`` from a query with (by, score, pos)."""
    lead, part = (f"{by}, ", f"PARTITION BY {by}") if by else ("", "")
    return f"""
WITH scored AS ({scored}),
points AS (SELECT {lead}score, CAST(sum(pos) AS BIGINT) AS pos, CAST(sum(1 - pos) AS BIGINT) AS neg
           FROM scored GROUP BY ALL),
curve AS (SELECT {lead}score, pos, neg,
       CAST(sum(pos) OVER ({part} ORDER BY score DESC) AS BIGINT) AS tp,
       CAST(sum(neg) OVER ({part} ORDER BY score DESC) AS BIGINT) AS fp,
       sum(neg) OVER ({part} ORDER BY score DESC) / sum(neg) OVER ({part}) AS fpr,
       sum(pos) OVER ({part} ORDER BY score DESC) / sum(pos) OVER ({part}) AS tpr FROM points)
"""


_BINARY = curve_sql(f"SELECT score, label AS pos FROM {src('predictions_binary')}")
_OVR = curve_sql(union(
    f"SELECT {i} AS class, p{i} AS score, CASE WHEN label = {i} THEN 1 ELSE 0 END AS pos "
    f"FROM {src('probabilities')}" for i in range(5)), "class")
_CURVE_COLS = ("round(score, 9) AS score, pos, neg, tp, fp, round(fpr, 9) AS fpr, "
               "round(tpr, 9) AS tpr FROM curve")
_AREA = "sum(neg * (tp - pos / 2e0)) / (sum(pos) * sum(neg))"
ORACLES["E11_roc_curve"] = _BINARY + f"SELECT {_CURVE_COLS}"
ORACLES["E12_roc_curve_ovr"] = _OVR + f"SELECT class, {_CURVE_COLS}"
ORACLES["E11_roc_curve_ranges"] = ORACLES["E11_roc_curve"]
ORACLES["E12_roc_curve_ovr_ranges"] = ORACLES["E12_roc_curve_ovr"]
ORACLES["E13_auc"] = _BINARY + f"SELECT round({_AREA}, 6) AS auc FROM curve"
ORACLES["E13_auc_ovr"] = _OVR + (
    f"SELECT class, round({_AREA}, 6) AS auc FROM curve GROUP BY class")
ORACLES["E14_auc_from_labels"] = f"""
SELECT round((avg(CASE WHEN label = 1 THEN prediction * 1e0 END)
              + avg(CASE WHEN label = 0 THEN 1e0 - prediction END)) / 2, 6) AS auc
FROM {src('predictions_binary')}"""
ORACLES["E14_macro_auc"] = _OVR + f"""
SELECT round(avg(auc), 6) AS auc FROM (SELECT {_AREA} AS auc FROM curve GROUP BY class) a"""

# --- verdicts

_MODELS = _FOLDS + f"""
, per AS (SELECT model_id, class, sum(support) AS support, sum(predicted) AS predicted,
                 sum(hits) AS hits FROM cls GROUP BY model_id, class),
per2 AS (SELECT *, coalesce(hits / nullif(predicted, 0), 0) AS "precision",
                coalesce(hits / nullif(support, 0), 0) AS recall,
                coalesce(2 * hits / nullif(support + predicted, 0), 0) AS f1_score FROM per),
m AS (SELECT model_id, sum(hits) / sum(support) AS accuracy, {weighted('precision')} AS p,
             {weighted('recall')} AS r, {weighted('f1_score')} AS f1,
             min(f1_score) AS worst_f1, max(support) AS most, min(support) AS least_,
             sum(hits) AS correct, sum(support) - sum(hits) AS incorrect,
             CASE WHEN count(*) FILTER (support > 0) = 2
                  THEN avg(recall) FILTER (support > 0) END AS roc_auc
      FROM per2 GROUP BY model_id),
j AS (SELECT m.*, cv.mean_accuracy, cv.std_accuracy, cv.mean_f1, cv.std_f1
      FROM m LEFT JOIN cv USING (model_id))
"""


def texts(*conditional: tuple[str, str]) -> str:
    """Joined texts whose condition holds; concat_ws skips nulls."""
    return "concat_ws(' | ', " + ", ".join(
        f"CASE WHEN {c} THEN {quoted(t)} END" for c, t in conditional) + ")"


_STRENGTHS = texts(
    ("accuracy > 85e-2", verdict.HIGH_ACCURACY),
    ("accuracy > 75e-2 AND accuracy <= 85e-2", verdict.GOOD_ACCURACY),
    ("f1 > 8e-1", verdict.BALANCED_F1), ("worst_f1 > 7e-1", verdict.EVEN_CLASSES),
    ("coalesce(roc_auc, 5e-1) > 8e-1", verdict.HIGH_AUC))
_STRENGTHS = (f"CASE WHEN {_STRENGTHS} = '' THEN {quoted(verdict.BASELINE)} "
              f"ELSE {_STRENGTHS} END AS strengths")
_WEAKNESSES = texts(
    ("accuracy < 6e-1", verdict.LOW_ACCURACY), ("f1 < 6e-1", verdict.POOR_F1),
    ("worst_f1 < 5e-1", verdict.POOR_CLASSES), ("most > 10 * least_", verdict.UNEVEN_SUPPORT),
    ("coalesce(roc_auc, 5e-1) < 7e-1", verdict.LOW_AUC)) + " AS weaknesses"
_RECOMMENDATIONS = texts(
    *[("accuracy < 7e-1", t) for t in verdict.FOR_ACCURACY],
    ("f1 < accuracy * 9e-1", verdict.FOR_F1),
    *[("std_accuracy > 1e-1", t) for t in verdict.FOR_FOLDS],
    ("incorrect > correct * 5e-1", verdict.FOR_ERRORS),
    *[("TRUE", t) for t in verdict.GENERAL]) + " AS recommendations"
_BAND = ("CASE WHEN coalesce(std_accuracy, 1) < 5e-2 THEN 'High' "
         "WHEN coalesce(std_accuracy, 1) < 1e-1 THEN 'Medium' ELSE 'Low' END AS stability")
_GRADE = "CASE " + " ".join(
    f"WHEN accuracy > {b} THEN {quoted(t)}" for b, t in verdict.CONCLUSIONS) + (
    f" ELSE {quoted(verdict.POOR_CONCLUSION)} END AS conclusion")
ORACLES["V1_strengths"] = _MODELS + f"SELECT model_id, {_STRENGTHS} FROM j"
ORACLES["V2_weaknesses"] = _MODELS + f"SELECT model_id, {_WEAKNESSES} FROM j"
ORACLES["V3_recommendations"] = _MODELS + f"SELECT model_id, {_RECOMMENDATIONS} FROM j"
ORACLES["V4_stability_band"] = _MODELS + f"SELECT model_id, {_BAND} FROM j"
ORACLES["V5_conclusion_grade"] = _MODELS + f"SELECT model_id, {_GRADE} FROM j"
ORACLES["V6_scorecard"] = _MODELS + f"""
SELECT model_id, round(accuracy, 6) AS accuracy, round(p, 6) AS precision_weighted,
       round(r, 6) AS recall_weighted, round(f1, 6) AS f1_weighted, round(roc_auc, 6) AS roc_auc,
       round(mean_accuracy, 6) AS mean_accuracy, round(std_accuracy, 6) AS std_accuracy,
       round(mean_f1, 6) AS mean_f1, round(std_f1, 6) AS std_f1, {_BAND}, {_STRENGTHS},
       {_WEAKNESSES}, {_RECOMMENDATIONS}, {_GRADE} FROM j"""
ORACLES["S4_results_tree"] = _MODELS + f"""
, cells AS (SELECT model_id, count(*) AS n_cells, CAST(sum(n) AS BIGINT) AS n_rows FROM (
              SELECT model_id, label, prediction, count(*) AS n FROM {src('models')} GROUP BY ALL) c
            GROUP BY model_id),
epochs AS (SELECT run_id AS model_id, count(*) AS n FROM {src('history')} GROUP BY run_id)
SELECT model_id, a.missing_before, a.missing_after, 'event_type' AS target,
       epochs.n AS total_epochs, CAST(epochs.n AS INT) AS n_rounds, round(accuracy, 6) AS accuracy,
       CAST(n_cells AS INT) AS n_cells, n_rows, CAST(n_folds AS INT) AS n_folds,
       round(j.mean_accuracy, 6) AS mean_accuracy,
       CAST(len(string_split(recommendations, ' | ')) AS INT) AS n_recommendations
FROM j JOIN cells USING (model_id) JOIN cv USING (model_id) JOIN epochs USING (model_id)
JOIN (SELECT model_id, {_RECOMMENDATIONS} FROM j) r USING (model_id),
({ORACLES["A19_missing_totals"]}) a"""
