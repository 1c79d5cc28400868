"""Quantiles that merge: KLL sketches for each group, kept for each batch and merged on read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of a sketch; a sketch of this size takes about 10 KB, however many values it has seen.
SIZE = 800


def rank_error(size: int = SIZE) -> float:
    """Share of the rows by which the rank of a quantile is off, at most, in 99 of 100 cases."""
    return 2.296 / size**0.9723


def sketch_values(df: DataFrame, by: Sequence[str], value: str, size: int = SIZE) -> DataFrame:
    """(by, sketch): one sketch for each group; nulls and NaNs are no values.

    Tasks build sketches of their own first, so a group of any size sends one sketch from each.
    """
    number = F.col(value).cast("double")
    known = F.when(~F.isnan(number), number)
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(known, size).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: Sequence[str], size: int = SIZE) -> DataFrame:
    """One sketch for each group from those of many batches, or of finer groups."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", size).alias("sketch"))


def quantiles(sketches: DataFrame, by: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """(by, n, share, value): values at the given shares of the n that a sketch has seen. A group
    without values has n = 0 and null values."""
    counted = sketches.select(*by, "sketch", F.kll_sketch_get_n_double("sketch").alias("n"))
    found = [
        F.struct(
            F.lit(float(share)).alias("share"),
            F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(share))))
            .alias("value"),
        )
        for share in shares
    ]
    return counted.select(*by, "n", F.inline(F.array(*found)))
