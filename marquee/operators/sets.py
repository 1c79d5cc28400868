"""Difference and union of frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Copies of one row that one task writes.
PIECE_COPIES = 100_000


def difference(left: DataFrame, right: DataFrame, keep_copies: bool = False) -> DataFrame:
    """Rows of `left` that are not in `right`; nulls are equal to each other.

    Copies are removed, unless `keep_copies` asks for the bag difference. One aggregate over the
    union decides which rows stay: copies are combined below its shuffle, so a row that occurs
    very often does no harm, and there is no join.
    """
    columns = left.columns
    tagged = left.withColumn("_right", F.lit(0)).union(
        right.select(*columns).withColumn("_right", F.lit(1))
    )
    if keep_copies:
        return _bag_difference(tagged, columns)
    kept = tagged.groupBy(*columns).agg(F.max("_right").alias("_right"))
    return kept.filter(F.col("_right") == 0).drop("_right")


def _bag_difference(tagged: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each row as often as it is left over. The copies of a row are written in pieces by many
    tasks, however many there are."""
    surplus = F.sum(F.when(F.col("_right") == 0, 1).otherwise(-1))
    counted = tagged.groupBy(*columns).agg(surplus.alias("_n")).filter("_n > 0")
    last = F.floor((F.col("_n") - 1) / PIECE_COPIES)
    pieces = counted.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    copies = F.least(F.lit(PIECE_COPIES), F.col("_n") - F.col("_piece") * PIECE_COPIES)
    spread = pieces.withColumn("_copies", copies.cast("int")).repartition(*columns, "_piece")
    return spread.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*columns)


def union_feeds(feeds: dict[str, DataFrame], name: str = "feed") -> DataFrame:
    """All feeds in one frame, with the feed's name in a column of its own."""
    parts = [df.withColumn(name, F.lit(feed)) for feed, df in feeds.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
