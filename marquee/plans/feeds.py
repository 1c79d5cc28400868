"""Queries: what is kept of a feed beside its rows, and the bucketed keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import values
from marquee.operators import heavy, quantiles
from marquee.plans.registry import query, table
from marquee.plans.views import ENOUGH
from marquee.schemas import ENVELOPE
from marquee.session import scratch_path
from marquee.sources import files
from marquee.streaming import buckets, feeds, offsets, runs, topics

#: Files that a micro-batch takes, of the eight that a table is published in.
FILES = 3
SHARES = (0.25, 0.5, 0.9)

_KEPT = T.StructType([T.StructField(name, T.StringType()) for name in ("review_id", "movie")])


def _orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("o"), "o_orderkey").alias("review_id"),
        F.col("o_orderpriority").alias("movie"),
        F.substring("o_orderpriority", 1, 1).alias("rating"),
    )


def _landed(spark, rows: DataFrame) -> tuple[str, DataFrame]:
    """Rows as a feed of several files, and its stream."""
    path = scratch_path(spark, "feed")
    rows.repartition(8).write.parquet(path)
    reader = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", str(FILES))
    return path, reader.parquet(path)


@query(
    "lost_offsets",
    """
    SELECT 'lines' AS topic, l_linenumber AS partition, l_orderkey + 1 AS first, next - 1 AS last,
           next - l_orderkey - 1 AS n
    FROM (SELECT l_linenumber, l_orderkey,
                 lead(l_orderkey) OVER (PARTITION BY l_linenumber ORDER BY l_orderkey) AS next
          FROM (SELECT DISTINCT l_linenumber, l_orderkey FROM lineitem))
    WHERE next > l_orderkey + 1
    """,
)
def lost_offsets(spark, sf_dir):
    """Line items as messages: the line's number is the partition, the order's the offset, so what
    no order has on a line is missing. Runs are kept for each micro-batch and merged."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.lit(None).cast("binary").alias("key"),
        F.encode(F.col("l_partkey").cast("string"), "UTF-8").alias("value"),
        F.lit("lines").alias("topic"),
        F.col("l_linenumber").cast("int").alias("partition"),
        F.col("l_orderkey").cast("long").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )
    _, stream = _landed(spark, lines.select(*ENVELOPE.fieldNames()))
    kept, progress = scratch_path(spark, "offsets"), scratch_path(spark, "progress")
    runs.finish(runs.keep_summaries(stream, offsets.offset_runs, kept, progress, interval=None))
    return offsets.missing_offsets(runs.read_summaries(spark, kept, offsets.RUNS))


@query(
    "feed_active_items",
    f"SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey HAVING count(*) >= {ENOUGH}",
)
def feed_active_items(spark, sf_dir):
    """Items with enough rows, by counters kept for each micro-batch and an exact second pass."""
    path, stream = _landed(spark, table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey"))
    kept, progress = scratch_path(spark, "cells"), scratch_path(spark, "progress")
    runs.finish(
        runs.keep_summaries(
            stream, lambda batch: heavy.count_cells(batch, "l_partkey"), kept, progress, interval=None
        )
    )
    cells = heavy.merge_cells(runs.read_summaries(spark, kept, heavy.CELLS))
    rows = spark.read.parquet(path)
    return heavy.frequent_in_feed(rows, "l_partkey", cells, ENOUGH, name="n")


def _kept_quantiles(spark, sf_dir) -> DataFrame:
    """Quantiles of the values of each type of event, from one sketch for each micro-batch."""
    _, stream = _landed(spark, table(spark, sf_dir, "events").select("event_type", "value"))
    kept, progress = scratch_path(spark, "sketches"), scratch_path(spark, "progress")
    by = ["event_type"]
    runs.finish(
        runs.keep_summaries(
            stream, lambda batch: quantiles.sketch_values(batch, by, "value"), kept, progress,
            interval=None,
        )
    )
    sketches = runs.read_summaries(spark, kept, "event_type string, sketch binary")
    return quantiles.quantiles(quantiles.merge_sketches(sketches, by), by, SHARES)


@query(
    "feed_quantiles",
    f"""
    SELECT event_type, count(value) AS n, share, true AS within_error
    FROM events, (SELECT unnest({list(SHARES)}) AS share) GROUP BY event_type, share
    """,
)
def feed_quantiles(spark, sf_dir):
    """Quantiles of a feed, each with the check that its rank among all rows is off by at most
    twice what the sketch promises in 99 of 100 cases."""
    found = _kept_quantiles(spark, sf_dir)
    events = table(spark, sf_dir, "events").select("event_type", F.col("value").alias("seen"))
    joined = events.join(found, "event_type")  # a row for each type and share
    below, upto = F.count_if(F.col("seen") < F.col("value")), F.count_if(F.col("seen") <= F.col("value"))
    slack = 2 * quantiles.rank_error() * F.col("n") + 1
    at = F.col("share") * F.col("n")
    within = (below <= at + slack) & (upto >= at - slack)
    return joined.groupBy("event_type", "n", "share").agg(within.alias("within_error"))


@query(
    "stream_once",
    "SELECT 'o' || o_orderkey AS review_id, o_orderpriority AS movie FROM orders",
)
def stream_once(spark, sf_dir):
    """A topic is drained, published again as a whole, and drained by the restarted stream: no
    review lands twice, though the sink only appends."""
    topic, landed, progress = (scratch_path(spark, n) for n in ("topic", "landed", "progress"))
    for _ in range(2):
        topics.publish_files(topics.as_messages(_orders(spark, sf_dir)), topic, "orders")
        stream = topics.message_text(topics.read_files(spark, topic))
        parsed = stream.select(F.from_json("value", _KEPT).alias("value"), "timestamp")
        rows = runs.once(parsed.select("value.*", "timestamp"), "review_id", "timestamp", "1 hour")
        kept = rows.select("review_id", "movie")
        runs.finish(runs.land_json(kept, landed, progress, interval=None))
    return files.read_json_lines(spark, landed, _KEPT)


@query(
    "stream_buckets",
    """
    SELECT sha256('["mubi-sqlite","o' || o_orderkey || '"]') AS id, 'o' || o_orderkey AS "reviewId",
           o_orderpriority AS "movieTitle", substr(o_orderpriority, 1, 1)::DOUBLE AS score
    FROM orders
    """,
)
def stream_buckets(spark, sf_dir):
    """A topic written twice into a bucketed keyed table, whose runs are merged in between. It gets
    buckets for all orders."""
    topic = scratch_path(spark, "topic")
    count = buckets.bucket_count(table(spark, sf_dir, "orders").count())
    messages = topics.as_messages(_orders(spark, sf_dir).repartition(8))
    topics.publish_files(messages, topic, "mubi-sqlite")
    row_id = values.stable_id(F.lit("mubi-sqlite"), F.col("review_id"))
    rows = feeds.parse(topics.read_files(spark, topic, max_files_per_trigger=FILES), "mubi-sqlite", row_id)
    keyed = buckets.KeyedTable(scratch_path(spark, "keyed"), rows.schema, buckets=count)
    for _ in range(2):
        runs.finish(
            buckets.upsert_buckets(rows, keyed, scratch_path(spark, "progress"), interval=None)
        )
    return buckets.read_buckets(spark, keyed).select("id", "reviewId", "movieTitle", "score")
