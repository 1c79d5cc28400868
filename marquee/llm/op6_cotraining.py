"""Query of operator 6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.llm.plans import query, table
from marquee.llm.quality import SCORES, rejected, score_documents


@query("op6_cotraining")
def op6_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probability that each document is poor or toxic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    scored = score_documents(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", *SCORES, (~rejected()).alias("kept"))
