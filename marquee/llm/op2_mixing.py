"""Query of operator 2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.llm.mixing import DOMAINS, WEIGHTS, corpus_budget, corpus_levels, mix
from marquee.llm.plans import query, table

EPOCHS = 4


def _level(depth: int, weight: str) -> str:
    """SQL for the shares of one level of the tree, from those of the level above."""
    keys = [f"l{i}" for i in range(1, depth + 1)]
    above = ", ".join(keys[:-1])
    by = f"PARTITION BY {above}" if above else ""
    using = f"JOIN s{depth - 1} USING ({above})" if above else "CROSS JOIN s0"
    names = ", ".join(keys)
    return f"""
n{depth} AS (
  SELECT *, {weight} AS w FROM (SELECT {names}, sum(cap) AS cap FROM leaf GROUP BY {names}) {using}
), r{depth} AS (
  SELECT *, (budget - coalesce(sum(cap) OVER ({by} ORDER BY cap / w, l{depth}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER ({by} ORDER BY cap / w, l{depth} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM n{depth}
), o{depth} AS (
  SELECT *, max(CASE WHEN cap <= rate * w THEN 0 ELSE 1 END) OVER ({by} ORDER BY cap / w, l{depth}
    ROWS UNBOUNDED PRECEDING) AS open
  FROM r{depth}
), s{depth} AS (
  SELECT {names}, CASE WHEN open = 0 THEN cap ELSE w * first_value(CASE WHEN open = 1 THEN rate END IGNORE NULLS)
    OVER ({by} ORDER BY cap / w, l{depth} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END AS budget
  FROM o{depth}
)"""


def _weights(level: str, column: str) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {w}" for name, w in WEIGHTS[level].items())
    return f"CAST(CASE {column} {cases} ELSE 1 END AS DOUBLE)"


SQL = rf"""
WITH d AS (
  SELECT doc_id, lang, source, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS tokens,
    md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS key,
    {list(DOMAINS)}[coalesce(TRY_CAST(regexp_extract(source, '(\d+)$', 1) AS INTEGER), 0) % {len(DOMAINS)} + 1] AS l1,
    coalesce(lang, '') AS l2, coalesce(source, '') AS l3
  FROM documents
), leaf AS (
  SELECT l1, l2, l3, sum(tokens)::BIGINT AS tokens, {EPOCHS} * sum(tokens)::DOUBLE AS cap FROM d GROUP BY l1, l2, l3
), s0 AS (SELECT least(sum(cap), 0.9::DOUBLE * sum(tokens)) AS budget FROM leaf
), {_level(1, _weights("domain", "l1"))}, {_level(2, _weights("language", "l2"))}, {_level(3, "1::DOUBLE")},
plan AS (
  SELECT *, floor(budget)::BIGINT // tokens AS passes, floor(budget)::BIGINT % tokens AS rest
  FROM leaf JOIN s3 USING (l1, l2, l3) WHERE tokens > 0
), placed AS (
  SELECT *, ('0x' || substr(md5('0:' || passes || ':' || key), 1, 15))::BIGINT AS place
  FROM d JOIN (SELECT l1, l2, l3, passes, rest FROM plan) USING (l1, l2, l3)
), taken AS (
  SELECT *, passes + CASE WHEN sum(tokens) OVER (PARTITION BY l1, l2, l3 ORDER BY place
    RANGE UNBOUNDED PRECEDING) <= rest THEN 1 ELSE 0 END AS times
  FROM placed
)
SELECT doc_id, lang, source, CAST(unnest(range(times)) AS INTEGER) AS epoch FROM taken
"""


@query("op2_mixing", SQL)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of a mix of domains, languages and sources, with the epochs they are in."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    mixed = mix(docs, WEIGHTS, corpus_budget(docs), corpus_levels(), EPOCHS)
    return mixed.select("doc_id", "lang", "source", "epoch")
