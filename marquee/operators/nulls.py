"""Dropping and filling missing values."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.ordering import value_at_rank

STRATEGIES = ("constant", "mean", "median", "exact_median")


def drop_missing(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """Rows without a null or NaN, in all columns or in a subset."""
    return df.dropna(subset=None if subset is None else list(subset))


def fill_values(
    df: DataFrame, columns: Sequence[str], strategy: str = "constant", constant: float = 0.0
) -> dict[str, float]:
    """The value that stands in for a missing one, for each column.

    Means and approximate medians of all columns come from one pass. A column without any value
    has no mean or median and is left out.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; supported: {', '.join(STRATEGIES)}")
    if strategy == "constant":
        return dict.fromkeys(columns, float(constant))
    values = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    if strategy == "mean":
        row = df.agg(*[F.mean(values[c]).alias(c) for c in columns]).collect()[0]
    elif strategy == "median":
        # Rank error at most 1/1000 of the rows.
        row = df.agg(*[F.percentile_approx(values[c], 0.5, 1000).alias(c) for c in columns])
        row = row.collect()[0]
    else:
        row = {c: exact_median(df.select(values[c].alias(c)), c) for c in columns}
    return {c: row[c] for c in columns if row[c] is not None}


def exact_median(df: DataFrame, column: str) -> float | None:
    """Lower median, found by narrowing the value range: no sort, no list of all values."""
    known = df.filter(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
    n = known.count()
    return value_at_rank(known, column, (n + 1) // 2) if n else None


def fill_missing(
    df: DataFrame, columns: Sequence[str], strategy: str = "constant", constant: float = 0.0
) -> DataFrame:
    values = fill_values(df, columns, strategy, constant)
    return apply_fill(df, values)


def apply_fill(df: DataFrame, values: dict[str, float]) -> DataFrame:
    """Fill nulls and NaNs with values found earlier, for instance on the training rows."""
    return df.fillna(values) if values else df
