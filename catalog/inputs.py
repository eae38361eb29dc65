"""Input tables of the registered queries, as SQL that Spark and DuckDB both run.

Each text reads whole tables; ``{name}`` stands for a driver table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

RANK = """CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2
          WHEN 'signup' THEN 3 ELSE 4 END"""

INPUTS = {
    # Orders with gaps: two below and two above the 30 % limit, one of them all empty.
    "orders_nulls": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN NULL
                    ELSE o_totalprice END AS o_totalprice,
               CASE WHEN o_orderstatus = 'P' AND o_totalprice > 250000 THEN NULL
                    ELSE o_orderpriority END AS o_orderpriority,
               CASE WHEN o_totalprice < 250000 THEN NULL
                    ELSE o_totalprice / 2 END AS half_price,
               CAST(NULL AS DOUBLE) AS no_price
        FROM {orders}""",
    # Every pending order appears twice.
    "orders_dups": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM {orders}
        UNION ALL
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM {orders}
        WHERE o_orderstatus = 'P'""",
    "lineitem_const": """
        SELECT l_quantity, l_extendedprice, l_discount, l_tax, CAST(5 AS DOUBLE) AS k
        FROM {lineitem}""",
    # Twenty-two numeric columns: few and many values, large and small, gaps, infinities.
    "lineitem_wide": """
        SELECT CAST(l_orderkey AS DOUBLE) AS x1, l_partkey AS x2, l_suppkey AS x3,
               l_linenumber AS x4, l_quantity AS x5, l_extendedprice AS x6, l_discount AS x7,
               l_tax AS x8, -l_extendedprice AS x9, l_extendedprice - 50000 AS x10,
               l_extendedprice * 1e6 AS x11, l_extendedprice / 1024 AS x12,
               CASE WHEN l_linenumber > 5 THEN NULL ELSE l_extendedprice END AS x13,
               CASE WHEN l_linenumber > 1 THEN NULL ELSE l_quantity END AS x14,
               CASE WHEN l_quantity > 17 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice END AS x15,
               CASE WHEN l_quantity > 49 THEN CAST('Infinity' AS DOUBLE)
                    ELSE l_extendedprice END AS x16,
               CASE WHEN l_quantity < 40 THEN CAST('-Infinity' AS DOUBLE)
                    ELSE l_extendedprice END AS x17,
               l_quantity * l_discount AS x18, l_partkey * 4096 + l_suppkey AS x19,
               CAST(5 AS DOUBLE) AS x20, CAST(NULL AS DOUBLE) AS x21,
               CASE WHEN l_linenumber = 1 THEN -l_tax ELSE l_tax END AS x22
        FROM {lineitem}""",
    "part_codes": """
        SELECT p_partkey, p_retailprice,
               CASE WHEN p_type = 'PROMO' THEN 'n/a' ELSE CAST(p_size AS VARCHAR(10)) END AS code
        FROM {part}""",
    "part_cat": """
        SELECT p_partkey, p_size, p_retailprice, p_type, p_brand,
               CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END AS size_class
        FROM {part}""",
    # Mostly zero, so both quartiles are 0.
    "sparse_count": """
        SELECT o_orderkey, o_totalprice,
               CASE WHEN o_orderstatus = 'P' AND o_totalprice > 250000 THEN 3 ELSE 0 END AS hits
        FROM {orders}""",
    # A rule as classifier: the class of an event, wrong for very large and very small values.
    "predictions": f"""
        SELECT event_id, value, label,
               CASE WHEN value > 80 THEN (label + 1) % 5 WHEN value < 5 THEN (label + 3) % 5
                    ELSE label END AS prediction
        FROM (SELECT event_id, value, {RANK} AS label FROM {{events}}) e""",
    # The same rule, never predicting class 4.
    "predictions_gap": f"""
        SELECT event_id, label, CASE WHEN guess = 4 THEN 0 ELSE guess END AS prediction
        FROM (SELECT event_id, label,
                     CASE WHEN value > 80 THEN (label + 1) % 5 ELSE label END AS guess
              FROM (SELECT event_id, value, {RANK} AS label FROM {{events}}) e) g""",
    "predictions_binary": """
        SELECT d.doc_id, l.quality AS label, CAST(d.n_chars AS DOUBLE) AS score,
               CASE WHEN d.n_chars > 500 THEN 1 ELSE 0 END AS prediction
        FROM {labels} l JOIN {documents} d ON l.doc_id = d.doc_id""",
    # Class probabilities whose maximum is the rule's prediction.
    "probabilities": """
        SELECT event_id, label,
               CASE WHEN prediction = 0 THEN 2e-1 + 8e-1 * t ELSE 2e-1 - 2e-1 * t END AS p0,
               CASE WHEN prediction = 1 THEN 2e-1 + 8e-1 * t ELSE 2e-1 - 2e-1 * t END AS p1,
               CASE WHEN prediction = 2 THEN 2e-1 + 8e-1 * t ELSE 2e-1 - 2e-1 * t END AS p2,
               CASE WHEN prediction = 3 THEN 2e-1 + 8e-1 * t ELSE 2e-1 - 2e-1 * t END AS p3,
               CASE WHEN prediction = 4 THEN 2e-1 + 8e-1 * t ELSE 2e-1 - 2e-1 * t END AS p4
        FROM (SELECT event_id, label, prediction, value / (value + 35) AS t
              FROM ({predictions}) q) r""",
    # A history per user: one epoch per day.
    "history": """
        SELECT user_id AS run_id, CAST(extract(day FROM ts) AS INT) AS epoch,
               max(value) / 120 AS loss, max(value) / 100 AS val_loss,
               CAST(sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) AS DOUBLE) / count(*)
                   AS accuracy,
               CAST(sum(CASE WHEN value < 60 THEN 1 ELSE 0 END) AS DOUBLE) / count(*)
                   AS val_accuracy,
               CASE WHEN CAST(extract(day FROM ts) AS INT) <= 20 THEN 1e-3 ELSE 5e-4 END AS lr
        FROM {events} GROUP BY user_id, CAST(extract(day FROM ts) AS INT)""",
    # Many models: groups of users, more accurate with a higher number.
    "models": f"""
        SELECT model_id, fold, label,
               CASE WHEN value > 15 + 15 * model_id THEN (label + 1) % 5
                    WHEN value < 2 THEN 0 ELSE label END AS prediction
        FROM (SELECT CAST(floor(user_id / 15e0) AS INT) AS model_id,
                     CAST(floor(extract(hour FROM ts) / 5e0) AS INT) AS fold,
                     value, {RANK} AS label FROM {{events}}) e""",
}


def expand(name: str) -> str:
    """The text of an input with inputs nested in it expanded; tables stay ``{table}``."""
    return re.sub(
        r"\{(\w+)\}", lambda m: expand(m[1]) if m[1] in INPUTS else m[0], INPUTS[name])


def sql_input(name: str) -> str:
    """DuckDB text of an input."""
    return re.sub(r"\{(\w+)\}", r"\1", expand(name))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spark_input(spark: SparkSession, sf: str, name: str) -> DataFrame:
    text = expand(name)
    tables = {t: table(spark, sf, t) for t in set(re.findall(r"\{(\w+)\}", text))}
    return spark.sql(text, **tables)
