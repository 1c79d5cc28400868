"""Train and test splits that come out the same on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.ordering import cut_value


def in_train(*key: str, percent: int = 80, seed: int = 42) -> Column:
    """Whether a row belongs to the training part, decided by the hash of its key alone.

    Unlike a random sample it does not change with the partitioning of the data.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])
    bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100
    return bucket < percent


def hash_split(
    df: DataFrame, *key: str, percent: int = 80, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test), disjoint and complete; rows with equal keys stay together."""
    train = in_train(*key, percent=percent, seed=seed)
    return df.filter(train), df.filter(~train)


def random_split(
    df: DataFrame, fraction: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Spark's own random split. Its membership depends on the partitioning of `df`."""
    train, test = df.randomSplit([fraction, 1 - fraction], seed)
    return train, test


def prefix_split(
    df: DataFrame, order: str, fraction: float = 0.8, **steps
) -> tuple[DataFrame, DataFrame]:
    """The first int(rows * fraction) rows by a unique number, and all the others.

    Because the number is unique, the others are the set difference of the two frames; both parts
    are filters.
    """
    n = int(df.count() * fraction)
    cut = cut_value(df.filter(F.col(order).isNotNull()), order, F.lit(1), n, **steps)
    if cut is None:
        return df.filter(F.lit(False)), df
    in_prefix = F.coalesce(F.col(order) <= F.lit(cut), F.lit(False))
    return df.filter(in_prefix), df.filter(~in_prefix)
