"""Queries: text, dates, payloads, terms."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import records, text, values
from marquee.operators import terms
from marquee.plans.registry import query, table
from marquee.sources.tables import spread


@query(
    "title_year",
    rf"""
    WITH t AS (SELECT p_partkey, CASE p_type
        WHEN 'ECONOMY' THEN p_name || ': ' || p_brand || ' (' || (1950 + p_size) || '– )'
        WHEN 'STANDARD' THEN p_name || ' (I) (' || (1950 + p_size) || '–' || (1960 + p_size) || ')'
        WHEN 'PROMO' THEN p_name || ' ' || p_brand
        ELSE p_name || ' (' || (1950 + p_size) || ')' END AS movie FROM part),
    m AS (SELECT *, regexp_extract(movie,
        '{text.TITLE_RULE}', ['name', 'year']) AS g FROM t)
    SELECT p_partkey, CASE WHEN g.year <> '' THEN trim(g.name) ELSE movie END AS movie,
           nullif(g.year, '') AS release_time
    FROM m
    """,
)
def title_year(spark, sf_dir):
    first, last = (F.col("p_size") + 1950).cast("string"), (F.col("p_size") + 1960).cast("string")
    name = F.col("p_name")
    scraped = (
        F.when(
            F.col("p_type") == "ECONOMY",
            F.concat(name, F.lit(": "), "p_brand", F.lit(" ("), first, F.lit("– )")),
        )
        .when(
            F.col("p_type") == "STANDARD",
            F.concat(name, F.lit(" (I) ("), first, F.lit("–"), last, F.lit(")")),
        )
        .when(F.col("p_type") == "PROMO", F.concat_ws(" ", name, "p_brand"))
        .otherwise(F.concat(name, F.lit(" ("), first, F.lit(")")))
    )
    title, year = text.title_parts(scraped)
    parts = table(spark, sf_dir, "part")
    return parts.select("p_partkey", title.alias("movie"), year.alias("release_time"))


@query(
    "date_reformat",
    """
    SELECT o_orderkey, CASE o_orderstatus
        WHEN 'P' THEN 'around ' || strftime(o_orderdate, '%B %Y')
        ELSE strftime(o_orderdate, '%Y-%m-%d') END AS review_date
    FROM orders
    """,
)
def date_reformat(spark, sf_dir):
    date = F.col("o_orderdate")
    scraped = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(date, "d MMMM yyyy"))
        .when(F.col("o_orderstatus") == "O", F.upper(F.date_format(date, "dd MMMM yyyy")))
        .otherwise(F.concat(F.lit("around "), F.date_format(date, "MMMM yyyy")))
    )
    rows = table(spark, sf_dir, "orders")
    return rows.select("o_orderkey", values.reformat_date(scraped).alias("review_date"))


@query(
    "year_to_date",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS review_date,
      CASE WHEN o_orderstatus <> 'P' THEN strftime(make_date(year(o_orderdate), 1, 1), '%Y-%m-%d')
      END AS release_time
    FROM orders
    """,
)
def year_to_date(spark, sf_dir):
    year = F.date_format("o_orderdate", "yyyy")
    sent = (
        F.when(F.col("o_orderstatus") == "F", year)
        .when(F.col("o_orderstatus") == "O", F.concat(year, F.lit(".0")))
        .otherwise("NaN")
    )
    rows = table(spark, sf_dir, "orders")
    return rows.select(
        "o_orderkey",
        values.iso_text(values.iso_date(F.date_format("o_orderdate", "yyyy-MM-dd"))).alias(
            "review_date"
        ),
        values.iso_text(values.year_start(sent)).alias("release_time"),
    )


@query(
    "parse_payload",
    """
    SELECT event_id::VARCHAR AS key, (props->>'$.k')::INTEGER AS k
    FROM events WHERE event_type <> 'error'
    """,
)
def parse_payload(spark, sf_dir):
    """Binary messages to typed fields; messages of errors are broken and skipped."""
    body = F.when(F.col("event_type") == "error", F.concat(F.lit("broken "), "props"))
    messages = table(spark, sf_dir, "events").select(
        F.encode(F.col("event_id").cast("string"), "UTF-8").alias("key"),
        F.encode(body.otherwise(F.col("props")), "UTF-8").alias("value"),
    )
    fields = T.StructType([T.StructField("k", T.StringType())])
    rows = records.payload_rows(messages, fields, "k")
    return rows.select(F.col("key").cast("string").alias("key"), values.to_int(F.col("k")).alias("k"))


@query(
    "serialize_rows",
    """
    SELECT event_id, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"'
      || event_type || '","note":' || CASE WHEN event_type = 'error' THEN '"bad"' ELSE 'null' END
      || '}' AS payload
    FROM events
    """,
)
def serialize_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.when(F.col("event_type") == "error", "bad").alias("note")
    )
    return rows.select("event_id", records.to_payload(*rows.columns).alias("payload"))


@query(
    "flat_records",
    """
    SELECT event_id, (props->>'$.k')::BIGINT AS "detail.k", user_id AS "detail.user.id",
           event_type AS "detail.user.action"
    FROM events
    """,
)
def flat_records(spark, sf_dir):
    nested = table(spark, sf_dir, "events").select(
        "event_id",
        F.struct(
            F.from_json("props", "k bigint").getField("k").alias("k"),
            F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("action")).alias(
                "user"
            ),
        ).alias("detail"),
    )
    return records.flatten(nested)


WORDS_SQL = r"""
  SELECT doc_id, unnest(CASE WHEN regexp_matches(t, '^\s+$') THEN [] ELSE
    regexp_split_to_array(regexp_replace(t, '\s+$', ''), '\s') END) AS term
  FROM (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents)
"""


def _texts(spark, sf_dir):
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


@query("tokens", f"SELECT doc_id, term, count(*) AS tf FROM ({WORDS_SQL}) GROUP BY doc_id, term")
def tokens(spark, sf_dir):
    return terms.term_counts(_texts(spark, sf_dir), "doc_id", "text")


@query(
    "tfidf",
    f"""
    WITH tf AS (SELECT doc_id, term, count(*) AS tf FROM ({WORDS_SQL}) GROUP BY doc_id, term),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
    SELECT doc_id, term, tf, df,
      round(tf * ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1.0)), 6) AS tfidf
    FROM tf JOIN df USING (term)
    """,
)
def tfidf(spark, sf_dir):
    found = terms.tf_idf(_texts(spark, sf_dir), "doc_id", "text")
    return found.withColumn("tfidf", F.round("tfidf", 6))
