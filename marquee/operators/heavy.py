"""Frequent values of a feed that never ends: counters that merge, then an exact count.

A count-min sketch is a table (row, cell, n). Each value has one cell in every row, so a cell
counts at least what its values count: a value with enough rows has only cells with enough rows.
Sketches of batches are added up, and only values in full cells are counted exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.frequency import frequent_values

CELLS = "row int, cell int, n long"
#: Cells in a row. Values pass the sketch for nothing once rows / WIDTH nears the threshold.
WIDTH = 1 << 16
DEPTH = 3


def _cell(column: str, row: int, width: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(row), F.col(column)), F.lit(width)).cast("int")


def count_cells(df: DataFrame, column: str, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """The sketch of a batch: at most `width` * `depth` rows. Nulls are not counted."""
    cells = [F.struct(F.lit(r).alias("row"), _cell(column, r, width).alias("cell")) for r in range(depth)]
    known = df.where(F.col(column).isNotNull())
    each = known.select(F.explode(F.array(*cells)).alias("at")).select("at.*")
    return each.groupBy("row", "cell").agg(F.count(F.lit(1)).alias("n"))


def merge_cells(cells: DataFrame) -> DataFrame:
    return cells.groupBy("row", "cell").agg(F.sum("n").alias("n"))


def candidates(
    df: DataFrame, column: str, cells: DataFrame, at_least: int, width: int = WIDTH, depth: int = DEPTH
) -> DataFrame:
    """Rows whose value may have `at_least` rows: none that has is left out.

    `cells` must be the merged sketch of at least these rows, of the same width and depth. A row of
    it has at most `width` cells, 256 KB, which is what each of the joins broadcasts.
    """
    full = cells.where(F.col("n") >= at_least)
    for row in range(depth):
        name = f"_cell{row}"
        hits = full.where(F.col("row") == row).select(F.col("cell").alias(name))
        df = df.withColumn(name, _cell(column, row, width))
        df = df.join(F.broadcast(hits), name, "left_semi").drop(name)
    return df


def frequent_in_feed(
    df: DataFrame,
    column: str,
    cells: DataFrame,
    at_least: int,
    width: int = WIDTH,
    depth: int = DEPTH,
    name: str = "count",
) -> DataFrame:
    """The values with at least that many rows and their exact counts, whatever the batches were.

    Only candidates are shuffled; where values are many and few of them frequent, that is little.
    """
    likely = candidates(df.select(column), column, cells, at_least, width, depth)
    return frequent_values(likely, column, at_least, name)
