"""Query of operator 13."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.plans import query, table
from marquee.llm.whitening import whiten


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight whitened components of every embedding."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = whiten(vectors, components=8, carry=["vec_id"])
    each = F.posexplode(F.arrays_zip("whitened", F.coalesce("explained", F.array()).alias("explained")))
    return found.select("vec_id", "n", "deviation", "identity_error", each.alias("at", "part")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        F.col("deviation").try_cast("long").alias("deviation"),
        F.col("part.whitened").alias("whitened"),
        F.col("part.explained").alias("explained"),
        "identity_error",
    )
