"""Every registered query against its SQL on the smallest driver tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog.oracles import ORACLES
from catalog.queries import QUERIES
from check import TABLES, compare

SF = "/root/testdata/sf0.001"
# Fitted models are covered by test_model; here the rest runs.
FITTED = {"M1_fit_classifier", "M1_fit_logistic", "M2_fit_early_stopping", "M5_predict",
          "M6_cross_validate", "S6_save_model", "T12_prepare_and_fit"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_only_fitted_models_lack_sql():
    assert set(QUERIES) - set(ORACLES) == FITTED
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    result, _ = compare(spark, duck, name, QUERIES[name], ORACLES[name], SF)
    assert result.startswith("ok"), result


def test_entry_has_one_row(spark):
    df = entry(spark)
    assert df.columns == ["precision", "recall", "f1"] and df.count() == 1
