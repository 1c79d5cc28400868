"""Typed sinks: conforming a frame to a declared schema, metrics log, external stores."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.schemas import METRICS
from marquee.session import path_exists


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns in the declared types; missing ones become typed nulls."""
    have = set(df.columns)
    columns = []
    for field in schema.fields:
        if field.name not in have:
            column = F.lit(None).cast(field.dataType)
        elif df.schema[field.name].dataType == field.dataType:
            column = F.col(f"`{field.name}`")
        else:
            column = F.col(f"`{field.name}`").try_cast(field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Create an empty table at `path` unless one is there."""
    if not path_exists(spark, path):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def append_table(df: DataFrame, path: str, schema: T.StructType) -> None:
    conform(df, schema).write.mode("append").parquet(path)


def log_metrics(
    spark: SparkSession,
    path: str,
    model: str,
    metrics: dict[str, float],
    run_id: str | None = None,
) -> None:
    """Add one row (time, model, rmse, mae, mse) to the metrics log.

    Each run has a folder of its own, so a run that is repeated under its id replaces its row.
    Without an id the row is a run of its own.
    """
    row = [(model, *(float(metrics[name]) for name in ("rmse", "mae", "mse")))]
    df = spark.createDataFrame(row, "model string, rmse double, mae double, mse double")
    stamped = conform(df.withColumn("ts", F.current_timestamp()), METRICS)
    folder = hashlib.sha256((run_id or uuid.uuid4().hex).encode()).hexdigest()
    stamped.coalesce(1).write.mode("overwrite").parquet(f"{path}/run={folder}")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the log, those that lie beside the runs' folders among them."""
    return spark.read.schema(METRICS).option("recursiveFileLookup", "true").parquet(path)


def bulk_write(
    df: DataFrame,
    open_client: Callable[[], Callable[[list[dict]], None]],
    batch_size: int = 500,
) -> None:
    """Send rows to an external store from the executors, in batches.

    `open_client` runs once in each partition and returns the call that takes a batch of rows.
    What it raises fails the task, which is retried; the rows carry stable ids, so a retry
    overwrites what the failed attempt had written.
    """

    def send(rows: Iterable) -> None:
        client = open_client()
        documents = (row.asDict(recursive=True) for row in rows)
        while batch := list(islice(documents, batch_size)):
            client(batch)

    df.foreachPartition(send)
