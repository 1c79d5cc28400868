"""Query of operator 4."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.lines import MIN_SITES, remove_spread_lines
from marquee.llm.plans import query, table

SQL = rf"""
WITH l AS (
  SELECT doc_id, coalesce(source, '') AS site, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents
), s AS (
  SELECT trim(line, ' ' || chr(9) || chr(13)) AS t FROM l WHERE t <> ''
  GROUP BY t HAVING count(DISTINCT site) >= {MIN_SITES}
), m AS (
  SELECT doc_id, line, i, trim(line, ' ' || chr(9) || chr(13)) IN (SELECT t FROM s) AS gone FROM l
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
  md5(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS text_md5
FROM m GROUP BY doc_id
"""


@query("op4_line_spread", SQL)
def op4_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand on several sources."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    cleaned = remove_spread_lines(docs)
    return cleaned.select(
        "doc_id", "n_lines", "n_removed", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5")
    )
