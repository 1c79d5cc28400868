"""Numbers for labels: the most frequent label is 0, equal counts go by label.

The ML library's indexer gathers all distinct labels on the driver. User and item ids have no
bound, so the index is a table here: built by a parallel rank, applied by a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.joins import join_many_to_one
from marquee.operators.ordering import with_rank


def fit_index(df: DataFrame, column: str) -> DataFrame:
    """(label, idx, n): one row for each non-null label."""
    label = F.col(column).cast("string").alias("label")
    counted = df.select(label).filter("label IS NOT NULL").groupBy("label")
    counted = counted.agg(F.count(F.lit(1)).alias("n"))
    ranked = with_rank(counted, [F.desc("n"), F.asc("label")], "idx")
    return ranked.select("label", (F.col("idx") - 1).alias("idx"), "n")


def apply_index(
    df: DataFrame,
    index: DataFrame,
    column: str,
    output: str,
    unseen: str = "keep",
    same_rows: bool = False,
    **sizes,
) -> DataFrame:
    """Add the index of each label. A label that is not in the index

    * `keep`: gets the number after the last one,
    * `error`: fails the job,
    * `skip`: drops its row.

    `same_rows` says that the index was fitted on these rows, so that its counts are theirs.
    """
    if unseen not in ("keep", "error", "skip"):
        raise ValueError(f"unknown handling of unseen labels: {unseen!r}")
    pairs = index.select(F.col("label").alias("_label"), F.col("idx").alias(output))
    labelled = df.withColumn("_label", F.col(column).cast("string"))
    how = "inner" if unseen == "skip" else "left"
    counts = index.select(F.col("label").alias("_label"), F.col("n").alias("_n"))
    joined = join_many_to_one(
        labelled, pairs, "_label", how, counts=counts if same_rows else None, **sizes
    )
    if unseen == "keep":
        size = index.agg(F.max("idx")).collect()[0][0]
        bucket = F.lit(0 if size is None else size + 1).cast("bigint")
        joined = joined.withColumn(output, F.coalesce(F.col(output), bucket))
    elif unseen == "error":
        message = F.concat(F.lit(f"unseen label in {column}: "), F.coalesce("_label", F.lit("NULL")))
        failed = F.raise_error(message).cast("bigint")
        joined = joined.withColumn(output, F.coalesce(F.col(output), failed))
    return joined.select(*df.columns, output)


def restore_labels(df: DataFrame, index: DataFrame, column: str, output: str, **sizes) -> DataFrame:
    """Add the label of each number; numbers without a label are dropped."""
    pairs = index.select(F.col("idx").cast("bigint").alias("_idx"), F.col("label").alias(output))
    numbered = df.withColumn("_idx", F.col(column).cast("bigint"))
    return join_many_to_one(numbered, pairs, "_idx", "inner", **sizes).drop("_idx")


def save_index(index: DataFrame, path: str) -> None:
    index.write.mode("overwrite").parquet(path)


def load_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("label string, idx bigint, n bigint").parquet(path)
