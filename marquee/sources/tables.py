"""Stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Use all cores for costly work on each row of a table that is read by less than half of them.

    `df` must be a plain scan. A large table has more splits than that and comes back as it is,
    without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * 2 > cores:
        return df
    return df.repartition(cores, *key)
