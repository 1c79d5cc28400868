"""Queries: files, messages, streams, the unified review table.

The tables are written out in the format a query is about, below the shared folder, and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import values
from marquee.operators import joins, sets
from marquee.plans.registry import query, table
from marquee.schemas import REVIEW, UNIFIED_REVIEW
from marquee.session import discard, scratch_path
from marquee.sources import files, lines, sinks
from marquee.sources.tables import spread
from marquee.streaming import feeds, runs, topics

# Rows that one JSON array file should hold at most, as one task reads it.
ROWS_PER_DOCUMENT = 200_000


def _reviews(spark, sf_dir) -> DataFrame:
    """One cleaned review for each event. Error events have no rating, as scraped rows may not."""
    return spread(table(spark, sf_dir, "events"), "event_id").select(
        F.concat(F.lit("rw"), "event_id").alias("review_id"),
        F.concat(F.lit('The "'), "event_type", F.lit('", part '), "user_id").alias("movie"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("rating"),
        F.date_format("ts", "yyyy-MM-dd").alias("review_date"),
        F.concat((F.col("user_id") + 1900).cast("string"), F.lit(".0")).alias("release_time"),
    )


_REVIEWS_SQL = """
  SELECT 'rw' || event_id AS review_id, 'The "' || event_type || '", part ' || user_id AS movie,
         CASE WHEN event_type <> 'error' THEN value END AS rating,
         strftime(ts, '%Y-%m-%d') AS review_date, (user_id + 1900) || '.0' AS release_time
  FROM events
"""


@query("csv_reviews", _REVIEWS_SQL)
def csv_reviews(spark, sf_dir):
    """Titles with quotes and commas survive the way through CSV."""
    path = scratch_path(spark, "csv")
    files.write_csv(_reviews(spark, sf_dir), path)
    return files.read_csv(spark, path, REVIEW)


@query("csv_columns", f"SELECT review_id, rating FROM ({_REVIEWS_SQL})")
def csv_columns(spark, sf_dir):
    path = scratch_path(spark, "csv")
    files.write_csv(_reviews(spark, sf_dir), path)
    return files.read_csv(spark, path, REVIEW, columns=["review_id", "rating"])


@query("csv_texts", "SELECT doc_id, text, lang FROM documents")
def csv_texts(spark, sf_dir):
    """Whole texts with line ends inside quoted fields."""
    path = scratch_path(spark, "csv")
    files.write_csv(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), path)
    schema = "doc_id bigint, text string, lang string"
    return files.read_csv(spark, path, T.StructType.fromDDL(schema), multi_line=True)


@query("json_lines", _REVIEWS_SQL)
def json_lines(spark, sf_dir):
    path = scratch_path(spark, "json")
    files.write_json_lines(_reviews(spark, sf_dir), path)
    return files.read_json_lines(spark, path, REVIEW)


@query("json_documents", _REVIEWS_SQL)
def json_documents(spark, sf_dir):
    """Several files, each one JSON array over many lines."""
    path = scratch_path(spark, "json")
    rows = _reviews(spark, sf_dir)
    count = rows.count() // ROWS_PER_DOCUMENT + 6
    files.write_json_documents(rows, path, ["review_id"], count)
    return files.read_json_documents(spark, f"{path}/part=*", REVIEW)


@query(
    "json_flat_documents",
    """
    SELECT o_orderkey AS id, o_custkey AS "who.customer", o_orderpriority AS "who.how.priority"
    FROM orders
    """,
)
def json_flat_documents(spark, sf_dir):
    """Array files of nested records, read as dotted columns."""
    path = scratch_path(spark, "json")
    how = F.struct(F.col("o_orderpriority").alias("priority"))
    nested = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_custkey").alias("customer"), how.alias("how")).alias("who"),
    )
    count = nested.count() // ROWS_PER_DOCUMENT + 1
    files.write_json_documents(nested, path, ["id"], count)
    return files.read_json_flat(spark, f"{path}/part=*", nested.schema)


@query(
    "json_list_lines",
    """
    SELECT o_orderkey AS id, 'price' AS kind, o_totalprice AS value FROM orders
    WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT o_orderkey, 'customer', CAST(o_custkey AS DOUBLE) FROM orders
    WHERE o_orderstatus <> 'P'
    """,
)
def json_list_lines(spark, sf_dir):
    """A list of two objects on each line; the lines of pending orders are broken and skipped."""
    path = scratch_path(spark, "json")
    item = F.array(
        F.struct(
            F.col("o_orderkey").alias("id"), F.lit("price").alias("kind"),
            F.col("o_totalprice").alias("value"),
        ),
        F.struct(
            F.col("o_orderkey").alias("id"), F.lit("customer").alias("kind"),
            F.col("o_custkey").cast("double").alias("value"),
        ),
    )
    line = F.when(F.col("o_orderstatus") == "P", F.lit("[{broken")).otherwise(F.to_json(item))
    table(spark, sf_dir, "orders").select(line).write.text(path)
    schema = T.StructType.fromDDL("id bigint, kind string, value double")
    return files.read_json_list_lines(spark, path, schema)


@query(
    "line_prefix",
    """
    SELECT line FROM (
      SELECT o_orderkey, o_orderkey || ',' || o_custkey || ',' || o_orderpriority AS line,
        sum(octet_length(encode(o_orderkey || ',' || o_custkey || ',' || o_orderpriority)) + 1)
          OVER (ORDER BY o_orderkey) AS upto
      FROM orders)
    WHERE upto <= 100000
    UNION ALL SELECT 'key,customer,priority'
    """,
)
def line_prefix(spark, sf_dir):
    """The first 100,000 bytes of a text table in file order, after its header."""
    path = scratch_path(spark, "lines")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("at"),
        F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderpriority").alias("value"),
    )
    head = spark.createDataFrame([(-1, "key,customer,priority")], orders.schema)
    head.union(orders).orderBy("at").select("value").write.text(path)
    return lines.leading_lines(spark, path, 100_000).select(F.col("value").alias("line"))


# One feed for each message shape, made of the whole tables.
_FEEDS_SQL = f"""
  SELECT 'imdb' AS feed, review_id AS "reviewId", NULL AS "userId", NULL AS "movieId",
         movie AS "movieTitle", CAST(NULL AS VARCHAR) AS "movieYear", CAST(rating AS FLOAT) AS rating,
         CAST(NULL AS DOUBLE) AS score, review_date, substr(release_time, 1, 4) || '-01-01'
         AS release_time
  FROM ({_REVIEWS_SQL})
  UNION ALL
  SELECT 'mubi-sqlite', 'o' || o_orderkey, 'c' || o_custkey, NULL, o_orderpriority, NULL,
         CAST(CASE WHEN o_orderstatus = 'F' THEN substr(o_orderpriority, 1, 1)::INTEGER END AS FLOAT),
         CASE WHEN o_orderstatus = 'F' THEN substr(o_orderpriority, 1, 1)::INTEGER * 2 END, NULL, NULL
  FROM orders
  UNION ALL
  SELECT 'rotten-tomatoes', 'l' || l_orderkey || '-' || l_linenumber, 's' || l_suppkey,
         'p' || l_partkey, p_name, CAST(1950 + p_size AS VARCHAR), CAST(ceil(l_quantity / 5) / 2 AS FLOAT),
         ceil(l_quantity / 5), NULL, NULL
  FROM lineitem JOIN part ON l_partkey = p_partkey
"""


def _raw_rows(spark, sf_dir) -> DataFrame:
    orders = spread(table(spark, sf_dir, "orders"), "o_orderkey")
    urgency = (F.substring("o_orderpriority", 1, 1).cast("int") * 2).cast("string")
    return orders.select(
        F.concat(F.lit("o"), "o_orderkey").alias("review_id"),
        F.concat(F.lit("c"), "o_custkey").alias("reviewer"),
        F.col("o_orderpriority").alias("movie"),
        F.when(F.col("o_orderstatus") == "F", urgency).alias("rating"),
        F.date_format("o_orderdate", "d MMMM yyyy").alias("review_date"),
        F.lit(0).alias("spoiler_tag"),
    )


def _site_rows(spark, sf_dir) -> DataFrame:
    score = F.ceil(F.col("l_quantity") / 5).cast("double")
    items = table(spark, sf_dir, "lineitem")
    site = spread(items, "l_orderkey", "l_linenumber").select(
        F.concat(F.lit("l"), "l_orderkey", F.lit("-"), "l_linenumber").alias("reviewId"),
        F.concat(F.lit("s"), "l_suppkey").alias("userId"),
        F.concat(F.lit("p"), "l_partkey").alias("movieId"),
        (score / 2).alias("rating"),
        score.alias("score"),
        F.lit(True).alias("isVerified"),
    )
    movies = table(spark, sf_dir, "part").select(
        F.concat(F.lit("p"), "p_partkey").alias("movieId"),
        F.concat((F.col("p_size") + 1950).cast("string"), F.lit(".0")).alias("movieYear"),
        F.col("p_name").alias("movieTitle"),
        "p_partkey",
    )
    return joins.lookup(site, movies, "movieId", "p_partkey", ["movieYear", "movieTitle"])


IMDB, MUBI, ROTTEN = feeds.FEEDS
# Rows of a feed are put together only where it is used.
_FEED_ROWS = {IMDB: _reviews, MUBI: _raw_rows, ROTTEN: _site_rows}


def _shown(rows: DataFrame) -> DataFrame:
    """Unified reviews without the id; dates and the year, which may be missing, as text."""
    shown = {c: values.iso_text(F.col(c)) for c in ("review_date", "release_time")}
    shown["movieYear"] = values.to_text(F.col("movieYear"))
    return rows.select(*[c for c in UNIFIED_REVIEW.fieldNames() if c != "id"]).withColumns(shown)


@query("unified_reviews", _FEEDS_SQL)
def unified_reviews(spark, sf_dir):
    """The three feeds as messages, parsed onto one schema and put together."""
    parsed = {
        topic: feeds.parse(topics.as_messages(rows(spark, sf_dir)), topic, F.expr("uuid()")).drop("feed")
        for topic, rows in _FEED_ROWS.items()
    }
    return _shown(sinks.conform(sets.union_feeds(parsed), UNIFIED_REVIEW))


@query(
    "stream_land",
    f"SELECT review_id, movie, rating, review_date, release_time FROM ({_REVIEWS_SQL})",
)
def stream_land(spark, sf_dir):
    """A topic, drained into JSON lines in micro-batches."""
    topic, landed, checkpoint = (scratch_path(spark, n) for n in ("topic", "landed", "progress"))
    topics.publish_files(topics.as_messages(_reviews(spark, sf_dir)), topic, IMDB)
    stream = topics.message_text(topics.read_files(spark, topic, max_files_per_trigger=100))
    rows = stream.select(F.from_json("value", REVIEW).alias("value")).select("value.*")
    runs.finish(runs.land_json(rows, landed, checkpoint, interval=None))
    return files.read_json_lines(spark, landed, REVIEW)


@query(
    "stream_append",
    f"""
    SELECT review_id, movie FROM ({_REVIEWS_SQL}) UNION ALL SELECT 'o' || o_orderkey,
      o_orderpriority FROM orders
    """,
)
def stream_append(spark, sf_dir):
    """What arrives after the first drain is appended by the second, and nothing is read twice."""
    topic, landed, checkpoint = (scratch_path(spark, n) for n in ("topic", "landed", "progress"))
    arrivals = (_reviews(spark, sf_dir), _raw_rows(spark, sf_dir))
    schema = T.StructType.fromDDL("review_id string, movie string")
    for rows in arrivals:
        topics.publish_files(topics.as_messages(rows), topic, "reviews")
        stream = topics.message_text(topics.read_files(spark, topic))
        parsed = stream.select(F.from_json("value", schema).alias("value")).select("value.*")
        runs.finish(runs.land_json(parsed, landed, checkpoint, interval=None))
    return files.read_json_lines(spark, landed, schema)


@query(
    "stream_upsert",
    f"""
    SELECT sha256('["{IMDB}","' || review_id || '"]') AS id, review_id AS "reviewId", movie AS "movieTitle",
           CAST(rating AS FLOAT) AS rating, review_date,
           substr(release_time, 1, 4) || '-01-01' AS release_time
    FROM ({_REVIEWS_SQL})
    """,
)
def stream_upsert(spark, sf_dir):
    """A topic written into the keyed table twice, the second time from the start under a new
    checkpoint: the table holds every review once."""
    topic, keyed = scratch_path(spark, "topic"), scratch_path(spark, "keyed")
    topics.publish_files(topics.as_messages(_reviews(spark, sf_dir)), topic, IMDB)
    row_id = values.stable_id(F.lit(IMDB), F.col("review_id"))
    rows = feeds.parse(topics.read_files(spark, topic, max_files_per_trigger=100), IMDB, row_id)
    for _ in range(2):
        runs.finish(runs.upsert(rows, keyed, scratch_path(spark, "progress"), interval=None))
    table_rows = runs.read_keyed(spark, keyed, rows.schema)
    dates = {c: values.iso_text(F.col(c)) for c in ("review_date", "release_time")}
    kept = table_rows.select(
        "id", "reviewId", "movieTitle", "rating", "review_date", "release_time"
    )
    return kept.withColumns(dates)


@query("stream_index", _FEEDS_SQL)
def stream_index(spark, sf_dir):
    """All three topics streamed into one keyed table, each with its own checkpoint. A topic goes once
    it is drained."""
    keyed = scratch_path(spark, "keyed")
    schema = None
    for topic, rows in _FEED_ROWS.items():
        path = scratch_path(spark, "topic")
        topics.publish_files(topics.as_messages(rows(spark, sf_dir)), path, topic)
        parsed = feeds.parse(topics.read_files(spark, path), topic)
        runs.finish(runs.upsert(parsed, keyed, scratch_path(spark, "progress"), interval=None))
        discard(spark, path)
        schema = parsed.schema
    return _shown(runs.read_keyed(spark, keyed, schema))


@query(
    "stream_two_publishes",
    f"""
    SELECT review_id AS "reviewId", movie AS "movieTitle" FROM ({_REVIEWS_SQL})
    UNION ALL SELECT 'o' || o_orderkey, o_orderpriority FROM orders
    """,
)
def stream_two_publishes(spark, sf_dir):
    """Two tables published to one topic one after the other, upserted under the ids that messages
    have by their place: nothing replaces anything."""
    topic, keyed = scratch_path(spark, "topic"), scratch_path(spark, "keyed")
    raw = _raw_rows(spark, sf_dir).select("review_id", "movie")
    for rows in (_reviews(spark, sf_dir), raw):
        topics.publish_files(topics.as_messages(rows), topic, IMDB)
    parsed = feeds.parse(topics.read_files(spark, topic), IMDB)
    runs.finish(runs.upsert(parsed, keyed, scratch_path(spark, "progress"), interval=None))
    return runs.read_keyed(spark, keyed, parsed.schema).select("reviewId", "movieTitle")


@query(
    "stream_land_raw",
    """
    SELECT 'landed' AS folder, '{"id":' || o_orderkey || ',"extra":{"status":"' || o_orderstatus
      || '"},"rating":"7"}' AS text
    FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT 'rejected', '{"id":' || o_orderkey || ',' FROM orders WHERE o_orderstatus = 'P'
    """,
)
def stream_land_raw(spark, sf_dir):
    """Messages land as they came, with fields that no schema names; broken ones land apart."""
    topic, landed, rejected = (scratch_path(spark, n) for n in ("topic", "landed", "rejected"))
    key = F.col("o_orderkey").cast("string")
    whole = F.concat(
        F.lit('{"id":'), key, F.lit(',"extra":{"status":"'), "o_orderstatus", F.lit('"},"rating":"7"}')
    )
    broken = F.concat(F.lit('{"id":'), key, F.lit(","))
    value = F.when(F.col("o_orderstatus") == "P", broken).otherwise(whole)
    messages = table(spark, sf_dir, "orders").select(
        F.encode(key, "UTF-8").alias("key"), F.encode(value, "UTF-8").alias("value")
    )
    topics.publish_files(messages, topic, IMDB)
    stream = topics.message_text(topics.read_files(spark, topic, max_files_per_trigger=100))
    run = runs.land_messages(stream, landed, rejected, scratch_path(spark, "progress"), interval=None)
    runs.finish(run)
    parts = [
        runs.read_landed(spark, path).select(F.lit(name).alias("folder"), "text")
        for name, path in (("landed", landed), ("rejected", rejected))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "stream_compact",
    f"""
    SELECT sha256('["{IMDB}","' || review_id || '"]') AS id, movie AS "movieTitle"
    FROM ({_REVIEWS_SQL})
    """,
)
def stream_compact(spark, sf_dir):
    """A keyed table that was made before anything arrived, written to twice and compacted."""
    topic, keyed, target = (scratch_path(spark, n) for n in ("topic", "keyed", "compact"))
    row_id = values.stable_id(F.lit(IMDB), F.col("review_id"))
    topics.publish_files(topics.as_messages(_reviews(spark, sf_dir)), topic, IMDB)
    rows = feeds.parse(topics.read_files(spark, topic), IMDB, row_id)
    sinks.ensure_table(spark, target, rows.schema)
    for _ in range(2):
        runs.finish(runs.upsert(rows, keyed, scratch_path(spark, "progress"), interval=None))
    runs.compact(spark, keyed, target, rows.schema)
    return runs.read_keyed(spark, target, rows.schema).select("id", "movieTitle")
