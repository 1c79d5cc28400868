"""Running streams: landing messages as JSON, and writing a table keyed by id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from marquee.operators.joins import BROADCAST_BYTES, fits, join_many_to_one
from marquee.session import discard_table, freed_shuffles, materialize, path_exists
from marquee.sources.sinks import conform

INTERVAL = "10 seconds"
# Up to this part of rows whose id was written again, those of other ids are told apart first.
MOST_REPEATED = 0.25


def _start(writer: DataStreamWriter, checkpoint: str, interval: str | None) -> StreamingQuery:
    """Start with a checkpoint of its own; without an interval, take what is there and stop."""
    writer = writer.option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def land_json(
    rows: DataFrame, path: str, checkpoint: str, interval: str | None = INTERVAL
) -> StreamingQuery:
    """Append the rows of each micro-batch as JSON lines. Progress is kept by the checkpoint, so
    neither written rows nor a remainder at the end are read again."""
    writer = rows.writeStream.format("json").outputMode("append")
    return _start(
        writer.option("path", path).option("ignoreNullFields", "false"), checkpoint, interval
    )


def land_messages(
    messages: DataFrame,
    path: str,
    rejects: str,
    checkpoint: str,
    interval: str | None = INTERVAL,
) -> StreamingQuery:
    """Append the text of each message (`value`) as one line, as it came; messages that are no JSON
    go to a folder of their own. Line ends, which JSON has only between its tokens, become blanks.

    A batch that is repeated after a failure replaces its own folders.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        parsed = F.from_json("value", "_bad string", {"columnNameOfCorruptRecord": "_bad"})
        line = F.regexp_replace("value", r"[\r\n]+", " ").alias("value")
        lines = batch.where("value is not null").select(line, parsed["_bad"].isNull().alias("good"))
        lines = lines.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for folder, kept in ((path, F.col("good")), (rejects, ~F.col("good"))):
                rows = lines.where(kept).select("value")
                rows.write.mode("overwrite").text(f"{folder}/stream={stream}/epoch={epoch}")
        finally:
            lines.unpersist()

    return each_batch(messages, write, checkpoint, interval)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """What `land_messages` has written below a folder, as `text`."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.withColumnRenamed("value", "text")


def each_batch(
    rows: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = INTERVAL,
) -> StreamingQuery:
    """Call `write(rows, epoch)` for every micro-batch; what it raises stops the stream."""
    writer = rows.writeStream.outputMode("update").foreachBatch(write)
    return _start(writer, checkpoint, interval)


def finish(query: StreamingQuery, timeout: float | None = None) -> None:
    """Wait for the end. A stream that outlives the timeout is stopped and reported."""
    ended = query.awaitTermination(timeout) if timeout is not None else query.awaitTermination()
    if timeout is not None and not ended:
        query.stop()
        raise TimeoutError(f"stream still running after {timeout} seconds")


def keep_summaries(
    rows: DataFrame,
    summary: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    interval: str | None = INTERVAL,
) -> StreamingQuery:
    """Keep `summary(batch)` of every micro-batch: offsets seen, sketches, counters. A batch that
    is repeated replaces its summary, so nothing is counted twice."""
    write = keyed_writer(path)
    return each_batch(rows, lambda batch, epoch: write(summary(batch), epoch), checkpoint, interval)


def read_summaries(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The kept summaries of all batches, to be merged by what has made them."""
    fields = T.StructType.fromDDL(schema)
    return spark.read.schema(fields).parquet(path).select(*fields.fieldNames())


def once(rows: DataFrame, key: str, time: str, horizon: str) -> DataFrame:
    """Rows of a stream whose key has not been seen within `horizon` of event time.

    The keys seen are state of the stream: a restart from its checkpoint knows them. They are
    dropped once the watermark has passed their time and the horizon, so state is bounded by what
    arrives in one horizon; rows that are later than the watermark are dropped as well.
    """
    return rows.withWatermark(time, horizon).dropDuplicatesWithinWatermark([key])


def keyed_writer(table: str) -> Callable[[DataFrame, int], None]:
    """Batch function that upserts into a keyed table.

    Every micro-batch becomes one folder, named by the stream and its epoch. A batch that is
    repeated after a failure replaces its own folder, so writing needs neither a shuffle nor a
    look at the rows already there. Rows with an id that exists supersede it when the table is
    read.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream:
            raise RuntimeError("keyed_writer runs inside a streaming query only")
        # ids are hexadecimal digits, which the default codec leaves as long as they are
        writer = batch.write.mode("overwrite").option("compression", "zstd")
        writer.parquet(f"{table}/stream={stream}/epoch={epoch}")

    return write


def upsert(
    rows: DataFrame, table: str, checkpoint: str, interval: str | None = INTERVAL
) -> StreamingQuery:
    return each_batch(rows, keyed_writer(table), checkpoint, interval)


def read_keyed(
    spark: SparkSession, table: str, schema: T.StructType, key: str = "id"
) -> DataFrame:
    """One row for each id, the one written last.

    `schema` is the stored one: columns whose name starts with an underscore say where a row came
    from, decide which one is last, and are left out of the result.
    """
    if not path_exists(spark, table):
        return visible(spark.createDataFrame([], schema))
    stored = spark.read.schema(schema).parquet(table)
    return visible(current(stored, schema, key))


def current(stored: DataFrame, schema: T.StructType, key: str = "id") -> DataFrame:
    """The same as `latest`. Where most ids were written once, which hashes of them tell, their rows are read without a
    shuffle: only rows that share a hash are ranked.
    """
    spark = stored.sparkSession
    hashed = F.xxhash64(key).alias("_hash")
    counted = stored.groupBy(hashed).agg(F.count(F.lit(1)).alias("_n"))
    with freed_shuffles(spark):
        again = materialize(counted.where("_n > 1"), "again")
        repeated = again.agg(F.sum("_n")).first()[0] or 0
        if repeated > MOST_REPEATED * stored.count():
            discard_table(again)
            return latest(stored, schema, key)
        if not repeated:
            discard_table(again)
            return stored.select(*schema.fieldNames())
        again = again.select("_hash")
        rows = stored.select(*schema.fieldNames(), hashed)
        more = join_many_to_one(rows, again, "_hash", "left_semi")
        small = F.broadcast(again) if fits(again, BROADCAST_BYTES) else again
    single = rows.join(small, "_hash", "left_anti").drop("_hash")
    return single.unionByName(latest(more.drop("_hash"), schema, key))


def latest(stored: DataFrame, schema: T.StructType, key: str = "id") -> DataFrame:
    """The newest row of each id. Ranks are limited below the shuffle too, so that an id written
    over and over sends one row from each task."""
    where = [name for name in schema.fieldNames() if name.startswith("_")]
    newest = Window.partitionBy(key).orderBy(*[F.desc(name) for name in where] or [F.lit(0)])
    ranked = stored.select(*schema.fieldNames(), F.row_number().over(newest).alias("_nth"))
    return ranked.filter("_nth = 1").drop("_nth")


def visible(df: DataFrame) -> DataFrame:
    return df.select(*[name for name in df.columns if not name.startswith("_")])


def compact(spark: SparkSession, table: str, target: str, schema: T.StructType) -> None:
    """Write the current rows of a keyed table as the first folder of a new one."""
    stored = spark.read.schema(schema).parquet(table)
    rows = conform(current(stored, schema), schema)
    rows.write.mode("overwrite").parquet(f"{target}/stream=compacted/epoch=0")
