"""Which offsets of a topic have landed, as runs of consecutive offsets, and which are missing.

A batch is reduced to its runs (topic, partition, first, last); runs of many batches merge into
fewer. So what is lost can be told without keeping, or reading again, the messages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PLACE = ["topic", "partition"]
RUNS = "topic string, partition int, first long, last long"
#: Offsets of one partition that one task looks at.
CELL = 1 << 16
#: Runs whose first offsets are in the same stretch of this length meet in one task.
CHUNK = 1 << 17
#: Messages or runs of one task, about. Without a number of parts, adaptive execution puts parts
#: together by their compressed bytes, a small part of what sorting them takes.
TASK_ROWS = 1 << 18


def offset_runs(messages: DataFrame, cell: int = CELL) -> DataFrame:
    """Runs of consecutive offsets of messages; repeated ones count once, null offsets not at all.

    Offsets are grouped by partition and cell, so one busy partition is shared by many tasks; a
    run that crosses cells is put together from one row for each of them.
    """
    known = messages.where("offset is not null").select(
        *PLACE, "offset", F.floor(F.col("offset") / cell).alias("cell")
    )
    parts = _parts(known)
    known = known.repartition(parts, *PLACE, "cell")
    nth = F.dense_rank().over(Window.partitionBy(*PLACE, "cell").orderBy("offset"))
    runs = known.withColumn("run", F.col("offset") - nth).groupBy(*PLACE, "cell", "run")
    runs = runs.agg(F.min("offset").alias("first"), F.max("offset").alias("last"))
    return merge_runs(runs, parts=parts)


def _parts(rows: DataFrame) -> int:
    return max(rows.count() // TASK_ROWS + 1, rows.sparkSession.sparkContext.defaultParallelism)


def merge_runs(runs: DataFrame, chunk: int = CHUNK, parts: int | None = None) -> DataFrame:
    """Runs that overlap or touch become one; the order in which runs are merged does not matter.

    Runs are merged chunk by chunk; what crosses chunks is told by one row for each chunk of a
    partition, so a busy partition is shared by many tasks, `parts` or as many as the runs need.
    """
    parts = parts or _parts(runs)
    inside = _merged_inside(_chunked(runs, chunk).repartition(parts, *PLACE, "chunk"))
    tops = inside.groupBy(*PLACE, "chunk").agg(F.max("last").alias("top"))
    known = _beside(inside, tops.withColumn("reach", F.max("top").over(_earlier_chunks())), "reach")
    # Runs of a chunk do not touch each other, so each that the earlier chunks do not reach opens
    # a run; the others belong to the run opened last before the chunk.
    opens = F.col("reach").isNull() | (F.col("first") > F.col("reach") + 1)
    known = known.withColumn("opens", opens)
    crossing = known.groupBy(*PLACE, "chunk").agg(
        F.max(F.when(F.col("opens"), F.col("first"))).alias("opened"),
        F.max(F.when(~F.col("opens"), F.col("last"))).alias("last"),
    )
    opened = F.last("opened", ignorenulls=True).over(_earlier_chunks())
    longer = crossing.withColumn("first", opened).where("last is not null")
    both = known.where("opens").select(*PLACE, "first", "last").unionByName(
        longer.select(*PLACE, "first", "last")
    )
    both = both.repartition(parts, *PLACE, "first")
    return both.groupBy(*PLACE, "first").agg(F.max("last").alias("last"))


def _chunked(runs: DataFrame, chunk: int) -> DataFrame:
    return runs.select(*PLACE, "first", "last", F.floor(F.col("first") / chunk).alias("chunk"))


def _merged_inside(runs: DataFrame) -> DataFrame:
    by_chunk = Window.partitionBy(*PLACE, "chunk").orderBy("first", "last")
    before = F.max("last").over(by_chunk.rowsBetween(Window.unboundedPreceding, -1))
    opens = before.isNull() | (F.col("first") > before + 1)
    numbered = runs.withColumn("opens", opens.cast("int"))
    numbered = numbered.withColumn("run", F.sum("opens").over(by_chunk))
    merged = numbered.groupBy(*PLACE, "chunk", "run").agg(
        F.min("first").alias("first"), F.max("last").alias("last")
    )
    return merged.drop("run")


def _earlier_chunks():
    return Window.partitionBy(*PLACE).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)


def _beside(runs: DataFrame, chunks: DataFrame, column: str) -> DataFrame:
    """Runs with a column of their chunk, of which `chunks` has one row. Null places are equal."""
    keys = [*PLACE, "chunk"]
    one = chunks.select(*[F.col(k).alias(f"_{k}") for k in keys], column)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return runs.join(one, same, "left").drop(*[f"_{k}" for k in keys])


def missing_offsets(runs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(topic, partition, first, last, n): what lies between the runs of each partition."""
    parts = _parts(runs)
    merged = _chunked(merge_runs(runs, chunk, parts), chunk).repartition(parts, *PLACE, "chunk")
    starts = merged.groupBy(*PLACE, "chunk").agg(F.min("first").alias("start"))
    later = F.lead("start").over(Window.partitionBy(*PLACE).orderBy("chunk"))
    known = _beside(merged, starts.withColumn("later", later), "later")
    next_first = F.lead("first").over(Window.partitionBy(*PLACE, "chunk").orderBy("first"))
    gaps = known.withColumn("next", F.coalesce(next_first, "later")).where("next is not null")
    return gaps.select(
        *PLACE,
        (F.col("last") + 1).alias("first"),
        (F.col("next") - 1).alias("last"),
        (F.col("next") - F.col("last") - 1).alias("n"),
    )
