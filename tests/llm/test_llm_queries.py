"""Every registered query of the subpackage against its SQL."""

from pathlib import Path

import duckdb
import pytest

from marquee.llm.registered import ORACLES, QUERIES
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
    assert len(got) > 0 and normal(got) == normal(tables.execute(ORACLES[name]).df())


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
