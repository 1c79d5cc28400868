"""Query of operator 7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.plans import query, table
from marquee.llm.sharding import ROW_BYTES, shard_by_bytes, text_bytes

SHARDS = 40
# A key belongs to the shard that the middle of its bytes falls into; the checksum's table and steps
# follow from its polynomial.
SQL = r"""
WITH tab AS (
  SELECT list(list_reduce([n] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)) AS n)
), d AS (
  SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 16 AS size,
    ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS a,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS b,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS bytes
  FROM documents
), k AS (
  SELECT a, b, sum(size) AS own FROM d GROUP BY a, b
), s AS (
  SELECT a, b, least(39, (2 * (sum(own) OVER (ORDER BY a, b) - own) + own) * 40 // (2 * sum(own) OVER ())) AS shard FROM k
)
SELECT doc_id, size, xor(list_reduce([4294967295] || bytes, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32,
  'bytes' AS law, CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY a, b, doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM d JOIN s USING (a, b), tab
"""


@query("op7_histogram_shards", SQL)
def op7_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of equal bytes."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "text",
        (text_bytes(F.col("text")) + ROW_BYTES).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
    )
    return shard_by_bytes(docs, SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
