"""Text lines in file order, and the longest run of leading lines within a byte budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.functions.text import byte_length

POSITION = ("file", "block", "seq")


FILE = "_metadata.file_path"


def read_lines(
    spark: SparkSession, path: str | list[str], where: Column | None = None
) -> DataFrame:
    """Lines with their position: file, start of the input split, order within the split.

    A split is read front to back by one task, so the increasing id orders the lines of a split,
    and the split's start orders the splits of a file. The id itself may differ from query to
    query. `where` is a condition on FILE; files that it excludes are not opened.
    """
    text = spark.read.text(path)
    if where is not None:
        text = text.filter(where)
    return text.select(
        "value",
        F.col(FILE).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_size"),
        F.monotonically_increasing_id().alias("seq"),
    )


def leading_lines(
    spark: SparkSession, path: str | list[str], budget: int, header: bool = True
) -> DataFrame:
    """Lines from the start, as long as their bytes with line ends stay within `budget`.

    The header line is kept and not counted. The first line that does not fit ends the run. Files
    that begin too far behind the budget are not read. Bytes are summed for each input split, then
    line by line only inside the one split where the budget runs out, so no task sees more than
    one split and the lines themselves are not shuffled.
    """
    found = _files(spark, path)
    first = found.filter("file_size > 0").agg(F.min("file").alias("file")).collect()[0].file
    if first is None:
        return read_lines(spark, path).select("value", *POSITION)
    if header:
        budget += _first_line_bytes(read_lines(spark, path, F.col(FILE) == first))
    # A line takes at least half as many bytes here as in the file, where it may end in two.
    begin = F.sum("file_size").over(
        Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    )
    near = found.withColumn("begin", F.coalesce(begin, F.lit(0))).filter(
        F.col("begin") <= 2 * budget
    )
    # All that follows reads the same files: how files are cut into splits depends on which files
    # are read. Conditions on the lines come after their id, so they do not select files.
    lines = read_lines(spark, path, F.col(FILE) <= near.agg(F.max("file")).collect()[0][0])
    cut = _split_over(lines, budget)
    if cut is None:
        return lines.select("value", *POSITION)
    file, block = F.col("file"), F.col("block")
    whole = lines.filter((file < cut.file) | ((file == cut.file) & (block < cut.block)))
    # Only the split where the budget runs out is looked at line by line.
    order = Window.orderBy("seq")
    upto = F.sum(_size()).over(order.rowsBetween(Window.unboundedPreceding, 0))
    unended = F.when(F.lead("seq").over(order).isNull(), F.lit(cut.unended)).otherwise(0)
    inside = lines.filter((file == cut.file) & (block == cut.block))
    inside = inside.withColumn("upto", F.lit(cut.before) + upto - unended)
    kept = inside.filter(F.col("upto") <= budget)
    return whole.select("value", *POSITION).union(kept.select("value", *POSITION))


def _size():
    return byte_length(F.col("value")) + 1


def _files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Name and size of each file, from the listing alone."""
    listing = spark.read.format("binaryFile").load(path)
    return listing.select(
        F.col(FILE).alias("file"), F.col("_metadata.file_size").alias("file_size")
    )


def _first_line_bytes(lines: DataFrame) -> int:
    """Size of the first line of one file; its first split is looked at first."""
    columns = lines.select("block", "seq", _size().alias("bytes"))
    head = columns.head()
    if head.block != 0:
        head = columns.orderBy("block", "seq").head()
    return head.bytes


def _split_over(lines: DataFrame, budget: int):
    """The split in which the running total exceeds the budget, or None.

    Works on one row for each input split: a table of the size of the file listing.
    """
    splits = lines.groupBy("file", "block").agg(
        F.sum(_size()).alias("bytes"), F.max("file_size").alias("file_size")
    )
    in_file = Window.partitionBy("file")
    # A last line without line end makes the file one byte shorter than its lines add up to.
    missing = F.sum("bytes").over(in_file) - F.col("file_size") == 1
    is_last = F.col("block") == F.max("block").over(in_file)
    splits = splits.withColumn("unended", (missing & is_last).cast("int"))
    upto = F.sum(F.col("bytes") - F.col("unended")).over(
        Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, 0)
    )
    over = splits.withColumn("upto", upto).filter(F.col("upto") > budget)
    over = over.withColumn("before", F.col("upto") - F.col("bytes") + F.col("unended"))
    rows = over.orderBy("file", "block").limit(1).collect()
    return rows[0] if rows else None
