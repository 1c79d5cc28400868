"""Projections by column name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.values import finite


def keep(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(*names)


def exclude(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the listed columns; names that are not there are ignored."""
    return df.drop(*names)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def cast_columns(df: DataFrame, names: Iterable[str], to: str = "double") -> DataFrame:
    """Cast some columns, pass the others; what does not convert becomes null."""
    chosen = set(names)
    floating = to in ("double", "float")

    def cast(name: str):
        value = F.col(f"`{name}`").try_cast(to)
        return finite(value) if floating else value

    return df.select(
        *[cast(name).alias(name) if name in chosen else F.col(f"`{name}`") for name in df.columns]
    )
