"""Prefixes, ranks and running totals over one global order, without a one-task window.

Two ways, by what is asked for:

* where the answer is a cut ("the first n rows", "as many rows as fit"), the order column's range
  is narrowed step by step with small aggregates until the cut value is known; the result is then
  a filter and no row is shuffled;
* where each row needs its rank or running total, rows are range-partitioned and sorted, and each
  partition's offset is added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.text import byte_length
from marquee.session import materialize

# Buckets of one narrowing step, and rows of the last range, which the driver looks at one by one.
BUCKETS = 1024
FEW = 10_000

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_EXACT_SPAN = 2**53


def _walk(df: DataFrame, budget, buckets: int | None = None, few: int | None = None):
    """(last, next): the greatest `v` whose rows and all earlier ones have a total `w` within the
    budget, and the first `v` that does not fit; None where there is no such value.

    `df` holds non-null `v` and non-negative `w`. Each step reads at most `buckets` + 1 rows.
    """
    buckets, few = buckets or BUCKETS, few or FEW
    integral = isinstance(df.schema["v"].dataType, _INTEGRAL)
    if not integral and not isinstance(df.schema["v"].dataType, (T.DoubleType, T.FloatType)):
        raise TypeError("the order column must be a whole or floating number")
    ends = df.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).collect()[0]
    lo, hi = ends.lo, ends.hi
    last, before = None, 0
    while lo is not None:
        span = df.filter(F.col("v").between(F.lit(lo), F.lit(hi)))
        rows = (
            span.groupBy(_bucket(lo, hi, integral, buckets).alias("b"))
            .agg(
                F.sum("w").alias("w"),
                F.count(F.lit(1)).alias("n"),
                F.min("v").alias("lo"),
                F.max("v").alias("hi"),
            )
            .orderBy("lo")
            .collect()
        )
        crossing = None
        for row in rows:
            if before + row.w > budget:
                crossing = row
                break
            before += row.w
            last = row.hi
        if crossing is None:
            return last, None
        if crossing.lo == crossing.hi:
            return last, crossing.lo
        lo, hi = crossing.lo, crossing.hi
        if crossing.n <= few:
            rest = df.filter(F.col("v").between(F.lit(lo), F.lit(hi)))
            for row in rest.groupBy("v").agg(F.sum("w").alias("w")).orderBy("v").collect():
                if before + row.w > budget:
                    return last, row.v
                before += row.w
                last = row.v
    return None, None


def _bucket(lo, hi, integral: bool, buckets: int) -> Column:
    """Equal slices of [lo, hi]; never decreasing in `v`, which is all that the walk needs."""
    if hi == lo:
        return F.lit(0)
    if integral and hi - lo < _EXACT_SPAN:
        distance, width = (F.col("v").cast("bigint") - F.lit(lo)).cast("double"), float(hi - lo)
    else:
        # Halves, so that the distance of two huge numbers stays finite.
        distance = F.col("v").cast("double") / 2 - F.lit(float(lo) / 2)
        width = float(hi) / 2 - float(lo) / 2
    return F.floor(distance / F.lit(width) * F.lit(float(buckets))).cast("int")


def cut_value(df: DataFrame, order: str, weight: Column, budget, *, buckets=None, few=None):
    """Greatest value of `order` such that all rows up to it weigh at most `budget` together.

    `order` must be a unique number: rows with an equal value are kept or left together.
    """
    pairs = df.select(F.col(order).alias("v"), weight.alias("w"))
    return _walk(pairs, budget, buckets, few)[0]


def value_at_rank(df: DataFrame, column: str, rank: int, *, buckets=None, few=None):
    """The `rank`-th smallest value (1 = smallest), ties counted one by one."""
    pairs = df.select(F.col(column).alias("v"), F.lit(1).alias("w"))
    return _walk(pairs, rank - 1, buckets, few)[1]


def first_rows(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The n first rows of an explicit order, for small n: each task sends at most n rows."""
    return df.orderBy(*order).limit(n)


def ordered_prefix(df: DataFrame, order: str, n: int, *, buckets=None, few=None) -> DataFrame:
    """The n first rows by a unique number, for any n: no sort, only a filter on `order`."""
    cut = cut_value(df, order, F.lit(1), n, buckets=buckets, few=few)
    return df.filter(F.lit(False) if cut is None else F.col(order) <= F.lit(cut))


def byte_prefix(
    df: DataFrame, order: str, text: str, budget: int, *, buckets=None, few=None
) -> DataFrame:
    """Rows from the start of `order` while the UTF-8 bytes of `text` stay within `budget`.

    The texts are measured once; the narrowing steps work on the stored sizes.
    """
    sizes = df.select(F.col(order).alias("v"), byte_length(F.col(text)).alias("w"))
    sizes = sizes.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cut = _walk(sizes, budget, buckets, few)[0]
    finally:
        sizes.unpersist()
    return df.filter(F.lit(False) if cut is None else F.col(order) <= F.lit(cut))


_IN_BLOCK = (1 << 33) - 1
# Rows of one range, about; ranges of more than 2^33 rows, which only equal values can make, fail.
BLOCK_ROWS = 1_000_000
# The engine limits ranks below the shuffle up to this k (spark.sql.optimizer.windowGroupLimitThreshold).
LIMITED_K = 1_000
SALTS = 256


def _placed(df: DataFrame, order: Sequence[str | Column], label: str) -> DataFrame:
    """Rows in globally ordered blocks: `_block` is the range, `_at` the place in it.

    Written once, because range bounds come from a sample and would differ if computed again. The
    number of ranges follows the number of rows.
    """
    shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(shuffles, df.count() // BLOCK_ROWS + 1)
    ordered = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    ids = ordered.withColumn("_id", F.monotonically_increasing_id())
    placed = ids.select(
        *df.columns,
        F.shiftright("_id", 33).cast("int").alias("_block"),
        F.col("_id").bitwiseAND(F.lit(_IN_BLOCK)).alias("_at"),
    )
    return materialize(placed, label)


def _offsets(totals: DataFrame, value: str) -> DataFrame:
    """What comes before each block. One row for each range partition, so small by construction.

    A block with more rows than places would run into the next one's numbers; its rows then
    outnumber its last place.
    """
    whole = F.when(F.col("_rows") == F.col("_last") + 1, F.col(value)).otherwise(
        F.raise_error(F.lit("a range holds more than 2^33 rows")).cast("bigint")
    )
    totals = totals.withColumn(value, whole)
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(value).over(earlier), F.lit(0)).alias("_before")
    return F.broadcast(totals.select("_block", before))


def _size() -> list[Column]:
    return [F.count(F.lit(1)).alias("_rows"), F.max("_at").alias("_last")]


def with_rank(df: DataFrame, order: Sequence[str | Column], name: str = "rank") -> DataFrame:
    """Add the 1-based position in a total order, computed in parallel."""
    placed = _placed(df, order, "rank")
    totals = placed.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"), *_size())
    ranked = placed.join(_offsets(totals, "_n"), "_block")
    return ranked.select(*df.columns, (F.col("_before") + F.col("_at") + 1).alias(name))


def with_running_total(
    df: DataFrame, order: Sequence[str | Column], weight: Column, name: str = "running"
) -> DataFrame:
    """Add the total weight up to and including each row of a total order."""
    placed = _placed(df.withColumn("_w", weight), order, "running")
    totals = placed.groupBy("_block").agg(F.sum("_w").alias("_n"), *_size())
    upto = (
        Window.partitionBy("_block").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    )
    summed = placed.withColumn("_upto", F.sum("_w").over(upto)).join(
        _offsets(totals, "_n"), "_block"
    )
    return summed.select(*df.columns, (F.col("_before") + F.col("_upto")).alias(name))


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, name: str = "rank"
) -> DataFrame:
    """The k first rows of each group.

    Ranks are limited to k below the shuffle as well (a window group limit in the plan), so a hot
    group sends at most k rows from each task. The engine does so for small k only; for a larger one
    a group is first ranked in parts, so that no more than SALTS * k of its rows meet.
    """
    if k > LIMITED_K:
        part = F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), F.lit(SALTS))
        salted = df.withColumn("_part", part)
        within = Window.partitionBy(*group, "_part").orderBy(*order)
        salted = salted.withColumn("_nth", F.row_number().over(within)).filter(F.col("_nth") <= k)
        df = salted.drop("_part", "_nth")
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col(name) <= k)
