"""Columns that must not clash with those of a given table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones that no column of `df` has, in any case of letters."""
    taken = {name.lower() for name in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """`df` without columns that are named, in any case of letters, like those to be added."""
    drop = {name.lower() for name in names}
    return df.select(*[f"`{name}`" for name in df.columns if name.lower() not in drop])
