"""Query of operator 8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.plans import query, table
from marquee.llm.urls import RULES, filter_urls, host_of, path_of, rule_of

RULES_SQL = r"""
WITH rules(host, path, said) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), u AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM u
), d AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path, row_number() OVER () AS nth
  FROM p
), fit AS (
  SELECT nth, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.said, length(r.host || r.path)) AS said
  FROM d JOIN rules r ON (d.host = r.host OR ends_with(d.host, '.' || r.host)) AND starts_with(d.path, r.path)
  GROUP BY nth
)
SELECT page_id, host, path, rule, said FROM d LEFT JOIN fit USING (nth)
"""


@query("op8_url_words")
def op8_url_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    judged = filter_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score", F.array_join("host_words", " ").alias("words"))


@query("url_rules", RULES_SQL)
def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the verdicts that needs no model: host, path and the rule that decides."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    rule, said = rule_of(F.col("host"), F.col("path"), RULES)
    return pages.withColumns({"rule": rule, "said": said})
