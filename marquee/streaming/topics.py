"""Messages: broker options, publishing rows, and a file topic with the broker's columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.records import to_payload
from marquee.schemas import ENVELOPE
from marquee.session import freed_shuffles, path_exists


def kafka_source_options(
    servers: str,
    topic: str,
    starting: str = "earliest",
    tolerate_lost_offsets: bool = False,
    max_offsets_per_trigger: int | None = None,
    **more: str,
) -> dict[str, str]:
    """Options of the Kafka source; credentials come from the caller as `more`."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(not tolerate_lost_offsets).lower(),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options | more


def read_kafka(spark: SparkSession, **options) -> DataFrame:
    """Stream of a broker topic; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_source_options(**options)).load()


def as_messages(df: DataFrame, key: Column | None = None) -> DataFrame:
    """Each row as one message: key and value as bytes, the value being JSON of all columns."""
    return df.select(
        F.encode(key.cast("string") if key is not None else F.lit(None).cast("string"), "UTF-8")
        .alias("key"),
        F.encode(to_payload(*df.columns), "UTF-8").alias("value"),
    )


def publish_kafka(messages: DataFrame, servers: str, topic: str, **more: str) -> None:
    """Send messages to a broker; batching is the connector's, and a failed send fails the job."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic} | more
    messages.write.format("kafka").options(**options).save()


def publish_files(messages: DataFrame, path: str, topic: str) -> None:
    """Append messages to a folder in the broker's shape.

    A plain file feed for where there is no broker. Partition and offset are the writing task and
    the place in it; they are stored with the message and do not change afterwards. Each call takes
    partitions of its own, after those that are there, so no two messages share a place. One writer
    at a time.
    """
    spark = messages.sparkSession
    used = None
    if path_exists(spark, path):
        used = spark.read.schema(ENVELOPE).parquet(path).agg(F.max("partition")).first()[0]
    base = 0 if used is None else used + 1
    at = F.monotonically_increasing_id()
    stored = messages.select(
        "key",
        "value",
        F.lit(topic).alias("topic"),
        (F.shiftright(at, 33) + base).cast("int").alias("partition"),
        at.bitwiseAND(F.lit((1 << 33) - 1)).alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
    with freed_shuffles(spark):
        stored.write.mode("append").option("compression", "zstd").parquet(path)


def read_files(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of a file topic."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def message_text(messages: DataFrame) -> DataFrame:
    """Key and value as text."""
    return messages.withColumns(
        {"key": F.col("key").cast("string"), "value": F.col("value").cast("string")}
    )
