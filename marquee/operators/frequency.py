"""Counting per value and keeping what is frequent enough."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.joins import join_many_to_one
from marquee.session import materialize


def counts(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """Rows per group; null is a group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """Non-null values, most frequent first, equal counts by value."""
    known = df.filter(F.col(column).isNotNull())
    return counts(known, column, name=name).orderBy(F.desc(name), F.asc(column))


def frequent_values(df: DataFrame, column: str, at_least: int, name: str = "count") -> DataFrame:
    """The non-null values with at least that many rows, and how many they have."""
    known = df.filter(F.col(column).isNotNull())
    return counts(known, column, name=name).filter(F.col(name) >= at_least)


def keep_frequent(df: DataFrame, column: str, at_least: int, **sizes) -> DataFrame:
    """Rows whose value occurs often enough; rows with a null value are dropped."""
    kept = materialize(frequent_values(df, column, at_least, "_n"), "frequent")
    return join_many_to_one(
        df, kept.select(column), column, "left_semi", counts=kept, **sizes
    )


def members(df: DataFrame, keys: DataFrame, column: str, **sizes) -> DataFrame:
    """Rows whose value is in a frame of keys, each row once."""
    return join_many_to_one(df, keys.select(column), column, "left_semi", derived=True, **sizes)


def frequent_item_stats(
    df: DataFrame, item: str, rating: str, at_least: int, extra: Sequence = ()
) -> DataFrame:
    """Rows, total and mean rating of the items with enough rated rows.

    Counting and averaging in one aggregate makes the join with the kept items unnecessary: the
    rows are combined below the only shuffle.
    """
    known = df.dropna(subset=[item, rating])
    stats = known.groupBy(item).agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.sum(rating).alias("sum_rating"),
        F.mean(rating).alias("avg_rating"),
        *extra,
    )
    return stats.filter(F.col("n_reviews") >= at_least)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def mean_of(df: DataFrame, *columns: str) -> DataFrame:
    return df.agg(*[F.mean(c).alias(c) for c in columns])
