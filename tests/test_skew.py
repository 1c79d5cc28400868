"""The queries that join, order or group once more, on tables where one value owns a third of the rows, and with
limits so small that every join is shuffled and split."""

from pathlib import Path

import duckdb
import pytest
from conftest import SF_DIR, plan_of

from __spark_entry__ import oracle_sql, queries
from marquee.operators import joins, ordering
from tools.compare import normal

# Every third row gets the same value in these columns.
HOT = {
    "lineitem": {"l_partkey": 7, "l_orderkey": 11, "l_quantity": 1.0},
    "orders": {"o_custkey": 3, "o_orderpriority": "'1-URGENT'"},
    "events": {"event_type": "'click'", "user_id": 3, "value": 5.0},
    "documents": {"text": "(SELECT text FROM source ORDER BY doc_id LIMIT 1)"},
    "part": {"p_name": "'red ring'", "p_brand": "'Brand#1'"},
}
CHOSEN = [
    "active_items", "als_coverage", "bag_difference", "byte_prefix", "difference", "hash_split",
    "index_unseen", "item_counts", "item_index", "item_stats", "json_documents", "label_index",
    "line_prefix", "lookup_enrich", "lookup_first", "member_rows", "null_fill", "prefix_split",
    "regression_metrics", "running_bytes", "stream_index", "stream_upsert", "tfidf", "tokens",
    "topk_per_user", "unified_reviews",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """The tables, and a connection with a view of each."""
    folder = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        name = path.stem
        connection.execute(
            f"CREATE OR REPLACE TEMP TABLE source AS SELECT *, row_number() OVER () AS _n FROM '{path}'"
        )
        hot = ", ".join(
            f"CASE WHEN _n % 3 = 0 THEN {value} ELSE {column} END AS {column}"
            for column, value in HOT.get(name, {}).items()
        )
        replaced = f"* EXCLUDE (_n) REPLACE ({hot})" if hot else "* EXCLUDE (_n)"
        target = folder / path.name
        connection.execute(
            f"COPY (SELECT {replaced} FROM source) TO '{target}' (ROW_GROUP_SIZE 2048)"
        )
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{target}'")
    return str(folder), connection


@pytest.fixture
def tiny_limits(monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(joins, "PIECE_ROWS", 50)
    monkeypatch.setattr(ordering, "FEW", 3)
    monkeypatch.setattr(ordering, "BUCKETS", 5)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_on_skewed_tables(spark, skewed, tiny_limits, name):
    folder, connection = skewed
    got = queries()[name](spark, folder).toPandas()
    want = connection.execute(oracle_sql()[name]).df()
    assert normal(got) == normal(want)


def test_no_table_is_broadcast_above_its_limit(spark, skewed, tiny_limits):
    folder, _ = skewed
    for name in ("lookup_enrich", "active_items", "regression_metrics"):
        assert "_piece" in plan_of(queries()[name](spark, folder))
