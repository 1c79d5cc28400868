"""Queries: counting, filtering, joining, ordering, splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions.text import byte_length, strip
from marquee.functions.values import to_int, to_text
from marquee.operators import (
    columns,
    frequency,
    joins,
    labels,
    metrics,
    nulls,
    ordering,
    sets,
    splits,
)
from marquee.plans.registry import query, table
from marquee.plans.views import ENOUGH, RATINGS_SQL, distinct_ratings, item_ratings, ratings
from marquee.session import materialize


@query(
    "item_stats",
    f"""
    SELECT l_partkey AS item_id, count(*) AS n_reviews, sum(ceil(l_quantity / 5)) AS sum_rating,
           avg(ceil(l_quantity / 5)) AS avg_rating
    FROM lineitem WHERE l_partkey IS NOT NULL AND l_quantity IS NOT NULL
    GROUP BY l_partkey HAVING count(*) >= {ENOUGH}
    """,
)
def item_stats(spark, sf_dir):
    return frequency.frequent_item_stats(item_ratings(spark, sf_dir), "item_id", "rating", ENOUGH)


@query(
    "active_items",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_partkey IN
      (SELECT l_partkey FROM lineitem GROUP BY l_partkey HAVING count(*) >= {ENOUGH})
    """,
)
def active_items(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )
    return frequency.keep_frequent(rows, "l_partkey", ENOUGH)


@query(
    "value_counts",
    """
    SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type
    """,
)
def value_counts(spark, sf_dir):
    return frequency.value_counts(table(spark, sf_dir, "events"), "event_type", "n")


@query(
    "item_counts",
    "SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY l_partkey",
)
def item_counts(spark, sf_dir):
    return frequency.value_counts(table(spark, sf_dir, "lineitem"), "l_partkey", "n")


@query(
    "group_counts",
    """
    SELECT CASE WHEN event_type <> 'error' THEN event_type END AS kind, count(*) AS n
    FROM events GROUP BY ALL
    """,
)
def group_counts(spark, sf_dir):
    kind = F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind")
    return frequency.counts(table(spark, sf_dir, "events").select(kind), "kind", name="n")


@query(
    "member_rows",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN
      (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    """,
)
def member_rows(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'")
    keys = customers.select(F.col("c_custkey").alias("o_custkey"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return frequency.members(rows, keys, "o_custkey")


@query(
    "table_summary",
    """
    SELECT count(*) AS n, avg(l_quantity) AS mean_quantity,
           round(avg(l_discount), 9) AS mean_discount
    FROM lineitem
    """,
)
def table_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.mean("l_quantity").alias("mean_quantity"),
        F.round(F.mean("l_discount"), 9).alias("mean_discount"),
    )


@query(
    "first_rows",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 100
    """,
)
def first_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return ordering.first_rows(rows, 100, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query(
    "hash_split",
    """
    SELECT o_orderkey, CASE WHEN
      ('0x' || substr(md5('42|' || o_orderkey::VARCHAR), 1, 8))::BIGINT % 100 < 80
      THEN 'train' ELSE 'test' END AS part
    FROM orders
    """,
)
def hash_split(spark, sf_dir):
    part = F.when(splits.in_train("o_orderkey"), "train").otherwise("test")
    return table(spark, sf_dir, "orders").select("o_orderkey", part.alias("part"))


@query(
    "prefix_split",
    """
    SELECT o_orderkey, o_custkey,
      CASE WHEN row_number() OVER (ORDER BY o_orderkey)
        <= (SELECT floor(count(*) * 0.8) FROM orders) THEN 'train' ELSE 'test' END AS part
    FROM orders
    """,
)
def prefix_split(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    train, test = splits.prefix_split(rows, "o_orderkey")
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


@query(
    "difference",
    """
    SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'
    EXCEPT SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'
    """,
)
def difference(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    pair = ["o_custkey", "o_orderpriority"]
    return sets.difference(
        rows.filter("o_orderstatus <> 'F'").select(*pair),
        rows.filter("o_orderstatus = 'F'").select(*pair),
    )


@query(
    "bag_difference",
    """
    SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'
    EXCEPT ALL SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'
    """,
)
def bag_difference(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    pair = ["o_custkey", "o_orderpriority"]
    return sets.difference(
        rows.filter("o_orderstatus <> 'F'").select(*pair),
        rows.filter("o_orderstatus = 'F'").select(*pair),
        keep_copies=True,
    )


@query(
    "lookup_enrich",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, p_name AS title,
           CAST(1950 + p_size AS VARCHAR) AS year
    FROM lineitem JOIN part ON l_partkey = p_partkey
    """,
)
def lookup_enrich(spark, sf_dir):
    reviews = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )
    items = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_name").alias("title"),
        (F.col("p_size") + 1950).cast("string").alias("year"),
    )
    return joins.lookup(reviews, items, "l_partkey", "year", ["title", "year"])


@query(
    "lookup_first",
    """
    SELECT event_id, user_id, o_orderkey, o_orderpriority FROM events JOIN
      (SELECT o_custkey, o_orderkey, o_orderpriority FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1)
    ON user_id = o_custkey
    """,
)
def lookup_first(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "user_id")
    return joins.lookup(
        events, orders, "user_id", "o_orderkey", ["o_orderkey", "o_orderpriority"]
    )


@query(
    "label_index",
    """
    SELECT event_type AS label, count(*) AS n,
           row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS idx
    FROM events WHERE event_type IS NOT NULL GROUP BY event_type
    """,
)
def label_index(spark, sf_dir):
    return labels.fit_index(table(spark, sf_dir, "events"), "event_type")


@query(
    "item_index",
    """
    SELECT l_partkey::VARCHAR AS label, count(*) AS n,
           row_number() OVER (ORDER BY count(*) DESC, l_partkey::VARCHAR) - 1 AS idx
    FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY l_partkey
    """,
)
def item_index(spark, sf_dir):
    return labels.fit_index(table(spark, sf_dir, "lineitem"), "l_partkey")


@query(
    "index_unseen",
    """
    WITH idx AS (
      SELECT o_custkey, row_number() OVER (ORDER BY count(*) DESC, o_custkey::VARCHAR) - 1 AS i
      FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
    SELECT o_orderkey, o_custkey, coalesce(i, (SELECT count(*) FROM idx)) AS user_index
    FROM orders LEFT JOIN idx USING (o_custkey)
    """,
)
def index_unseen(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    index = labels.fit_index(rows.filter("o_orderstatus = 'F'"), "o_custkey")
    return labels.apply_index(
        rows.select("o_orderkey", "o_custkey"), index, "o_custkey", "user_index", unseen="keep"
    )


@query(
    "index_known",
    """
    SELECT o_orderkey, i AS user_index FROM orders JOIN (
      SELECT o_custkey, row_number() OVER (ORDER BY count(*) DESC, o_custkey::VARCHAR) - 1 AS i
      FROM orders GROUP BY o_custkey) USING (o_custkey)
    """,
)
def index_known(spark, sf_dir):
    """The index of labels that are all known: none fails the job."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    index = labels.fit_index(rows, "o_custkey")
    numbered = labels.apply_index(rows, index, "o_custkey", "user_index", "error", same_rows=True)
    return numbered.select("o_orderkey", "user_index")


@query(
    "top_orders",
    """
    SELECT o_orderpriority, rank, o_orderkey FROM (
      SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank
      FROM orders)
    WHERE rank <= 1500
    """,
)
def top_orders(spark, sf_dir):
    """More of each group than the engine limits below a shuffle."""
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice", "o_orderkey")
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    top = ordering.top_per_group(rows, ["o_orderpriority"], order, 1500, "rank")
    return top.select("o_orderpriority", F.col("rank").cast("bigint").alias("rank"), "o_orderkey")


@query(
    "topk_per_user",
    f"""
    SELECT user_id, rank, item_id, rating FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rank
      FROM (SELECT user_id, item_id, avg(rating) AS rating FROM ({RATINGS_SQL})
            GROUP BY user_id, item_id))
    WHERE rank <= 3
    """,
)
def topk_per_user(spark, sf_dir):
    scored = distinct_ratings(spark, sf_dir)
    top = ordering.top_per_group(
        scored, ["user_id"], [F.desc("rating"), F.asc("item_id")], 3, "rank"
    )
    return top.select("user_id", F.col("rank").cast("bigint").alias("rank"), "item_id", "rating")


def item_mean_predictions(spark, sf_dir):
    """Each rating with its item's mean. The ratings are put together once; the aggregate that
    gives the means also counts them for the join."""
    rated = materialize(ratings(spark, sf_dir), "rated")
    means = rated.groupBy("item_id").agg(
        F.mean("rating").alias("prediction"), F.count(F.lit(1)).alias("_n")
    )
    means = materialize(means, "means")
    return joins.join_many_to_one(
        rated, means.select("item_id", "prediction"), "item_id", counts=means.select("item_id", "_n")
    )


ITEM_MEAN_ERRORS = f"""
  SELECT count(*) AS n, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae,
         round(avg(e * e), 6) AS mse
  FROM (SELECT rating - avg(rating) OVER (PARTITION BY item_id) AS e FROM ({RATINGS_SQL}))
"""


@query("regression_metrics", ITEM_MEAN_ERRORS)
def regression_metrics(spark, sf_dir):
    found = metrics.error_frame(item_mean_predictions(spark, sf_dir), "rating", "prediction")
    return found.select("n", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "mse")])


@query(
    "byte_prefix",
    """
    SELECT doc_id, n_bytes FROM (
      SELECT doc_id, octet_length(encode(text)) AS n_bytes,
             sum(octet_length(encode(text))) OVER (ORDER BY doc_id) AS upto FROM documents)
    WHERE upto <= 1000000
    """,
)
def byte_prefix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = ordering.byte_prefix(docs, "doc_id", "text", 1_000_000)
    return kept.select("doc_id", byte_length(F.col("text")).alias("n_bytes"))


@query(
    "running_bytes",
    """
    SELECT doc_id, CAST(sum(octet_length(encode(text))) OVER (ORDER BY doc_id) AS BIGINT)
      AS running FROM documents
    """,
)
def running_bytes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    sizes = docs.select("doc_id", byte_length(F.col("text")).alias("n_bytes"))
    rows = ordering.with_running_total(sizes, ["doc_id"], F.col("n_bytes"))
    return rows.select("doc_id", "running")


_GAPPY_SQL = """
  SELECT event_id, CASE WHEN event_type <> 'click' THEN value END AS value FROM events
"""


def _gappy(spark, sf_dir):
    value = F.when(F.col("event_type") != "click", F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", value.alias("value"))


@query(
    "null_fill",
    f"""
    WITH g AS ({_GAPPY_SQL})
    SELECT event_id, coalesce(value, 0) AS with_constant,
      round(coalesce(value, (SELECT avg(value) FROM g)), 6) AS with_mean,
      coalesce(value, (SELECT quantile_disc(value, 0.5) FROM g)) AS with_median
    FROM g
    """,
)
def null_fill(spark, sf_dir):
    rows = _gappy(spark, sf_dir)
    found = {s: nulls.fill_values(rows, ["value"], s) for s in ("constant", "mean", "exact_median")}
    wide = rows.select(
        "event_id",
        F.col("value").alias("with_constant"),
        F.col("value").alias("with_mean"),
        F.col("value").alias("with_median"),
    )
    filled = nulls.apply_fill(
        wide,
        {
            "with_constant": found["constant"]["value"],
            "with_mean": found["mean"]["value"],
            "with_median": found["exact_median"]["value"],
        },
    )
    return filled.withColumn("with_mean", F.round("with_mean", 6))


@query(
    "approx_median",
    f"""
    SELECT count(*) AS n, true AS within_error FROM ({_GAPPY_SQL}) WHERE value IS NOT NULL
    """,
)
def approx_median(spark, sf_dir):
    """The approximate median, with the check that its rank is off by at most one in a thousand
    rows, counted in whole rows."""
    rows = nulls.drop_missing(_gappy(spark, sf_dir), ["value"])
    found = nulls.fill_values(rows, ["value"], "median")["value"]
    n = F.count(F.lit(1))
    below, upto = F.count_if(F.col("value") < found), F.count_if(F.col("value") <= found)
    within = (below <= n * 0.501 + 1) & (upto >= n * 0.499 - 1)
    return rows.agg(n.alias("n"), within.alias("within_error"))


@query(
    "drop_nulls",
    f"SELECT event_id, value FROM ({_GAPPY_SQL}) WHERE event_id IS NOT NULL AND value IS NOT NULL",
)
def drop_nulls(spark, sf_dir):
    return nulls.drop_missing(_gappy(spark, sf_dir))


@query(
    "column_edits",
    r"""
    SELECT c_custkey AS customer_id, substr(c_name, 1, 8) AS prefix,
           TRY_CAST(substr(c_name, 10) AS DOUBLE) AS number, TRY_CAST(c_name AS DOUBLE) AS no_number,
           CAST(trunc(c_acctbal) AS INTEGER) AS whole, c_mktsegment AS segment
    FROM customer
    """,
)
def column_edits(spark, sf_dir):
    """Substring, cast by name, rename, drop and strip."""
    rows = table(spark, sf_dir, "customer").withColumns(
        {
            "prefix": F.substring("c_name", 1, 8),
            "number": F.substring("c_name", 10, 20),
            "no_number": F.col("c_name"),
            "whole": to_int(to_text(F.col("c_acctbal"))),
            "segment": strip(F.concat(F.lit("\t "), "c_mktsegment", F.lit(" \n"))),
        }
    )
    rows = columns.exclude(rows, ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    rows = columns.cast_columns(rows, ["number", "no_number"])
    return columns.rename(rows, {"c_custkey": "customer_id"})
