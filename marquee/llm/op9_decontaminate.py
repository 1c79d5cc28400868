"""Query of operator 9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.decontaminate import find_leaks
from marquee.llm.plans import query, table


@query("op9_decontaminate")
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold copies of benchmark items, with the items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
