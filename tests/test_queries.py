"""Every registered query against its SQL."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from marquee.plans import ORACLES, QUERIES
from tools.compare import normal


@pytest.fixture(scope="module")
def tables(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, tables, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = tables.execute(ORACLES[name]).df()
    assert len(got) > 0
    assert normal(got) == normal(want)


# Fitted values; what SQL can know of them is checked by als_learns and regression_learns.
FITTED = {
    "als_predict", "als_topk", "als_metrics", "linear_predict", "forest_predict",
    "boosted_predict", "category_predict", "regression_run_metrics", "hashed_tfidf",
}


def test_every_other_query_of_the_library_has_sql():
    assert set(QUERIES) == set(ORACLES) | FITTED and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(FITTED))
def test_fitted_values(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert len(got) > 0 and not got.isna().any().any()
    for column in {"rating_prediction", "weight"} & set(got):
        assert got[column].nunique() > 1  # no constant
    if "rmse" in got:
        (row,) = got.to_dict("records")
        assert row["mse"] == pytest.approx(row["rmse"] ** 2) and 0 < row["mae"] <= row["rmse"]


def test_entry(spark):
    assert entry(spark).columns == ["item_id", "n_reviews", "sum_rating", "avg_rating"]


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
