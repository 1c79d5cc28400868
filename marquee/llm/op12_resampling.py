"""Query of operator 12."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.llm.plans import query, table
from marquee.llm.resampling import resample

SQL = r"""
WITH tab AS (
  SELECT list(list_reduce([n] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)) AS n)
), texts AS (
  SELECT row_number() OVER () AS r, doc_id, text, false AS wanted FROM documents
  UNION ALL SELECT NULL, NULL, text, true FROM benchmark
), words AS (
  SELECT r, doc_id, wanted, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), runs AS (
  SELECT r, wanted, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
    || list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS f FROM words
), counted AS (
  SELECT r, wanted, f, count(*) AS n FROM runs GROUP BY ALL
), hashed AS (
  SELECT f, xor(list_reduce([4294967295] || list_transform(regexp_extract_all(hex(encode(f)), '..'), lambda h: ('0x' || h)::BIGINT),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS b
  FROM (SELECT DISTINCT f FROM counted), tab
), bagged AS (
  SELECT r, wanted, b, sum(n) AS n FROM counted JOIN hashed USING (f) GROUP BY ALL
), totals AS (
  SELECT coalesce(sum(n) FILTER (NOT wanted), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (wanted), 0)::DOUBLE AS t FROM bagged
), gains AS (
  SELECT b, floor(1000 * ln((coalesce(sum(n) FILTER (wanted), 0)::DOUBLE + 1) * (any_value(s) + 10000)
    / ((coalesce(sum(n) FILTER (NOT wanted), 0)::DOUBLE + 1) * (any_value(t) + 10000))))::BIGINT AS gain
  FROM bagged, totals GROUP BY b
), weights AS (
  SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM bagged JOIN gains USING (b) WHERE NOT wanted GROUP BY r
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS drawable,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296)))::BIGINT AS score
  FROM words LEFT JOIN weights USING (r) WHERE NOT wanted
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY drawable ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (drawable) OVER () * 5 // 100 AS take FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN drawable AND place <= take THEN place END AS rank FROM placed
"""


@query("op12_resampling", SQL)
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A twentieth of the documents, drawn towards the benchmark's distribution."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resample(docs, table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
