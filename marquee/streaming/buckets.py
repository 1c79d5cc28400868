"""A table keyed by id whose rows lie in hash buckets of the id, with tiered merging.

Each batch is a run: a partition of a bucketed table. A manifest names the runs that count. Runs of
a tier that grow to `fan_in` are merged into one of the next tier, so a row is rewritten once for
each tier and a reader meets few runs. The manifest is replaced as a whole, last; runs it no longer
names stay on disk until `forget`, so a reader that has begun is not disturbed.

The newest row of an id is found bucket by bucket: reading shuffles nothing, merging neither. One
driver writes a table at a time; its streams take turns.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators import versions
from marquee.session import hadoop_path
from marquee.sources.sinks import conform
from marquee.streaming.runs import INTERVAL, each_batch, latest, visible

#: Ids that a bucket should hold at most: its task sorts every stored row of them.
BUCKET_IDS = 500_000
_MANIFEST = "run string, tier int, buckets int"
_turn = threading.RLock()


@dataclass(frozen=True)
class KeyedTable:
    """Where a table is and how it is laid out.

    Columns of `schema` whose name starts with an underscore order the rows of an id. A bucket is
    read by one task: choose `buckets` so that one holds about a gigabyte. It cannot be changed.
    """

    path: str
    schema: T.StructType
    key: str = "id"
    buckets: int = 64
    fan_in: int = 4


def bucket_count(ids: int, least: int = 8) -> int:
    """Buckets of a table that is to hold so many ids."""
    return max(least, ids // BUCKET_IDS + 1)


def _stored(spark: SparkSession, table: KeyedTable, runs: list[str]) -> DataFrame:
    """The rows of some runs, as a bucketed scan."""
    name = _catalog_name(spark, table)
    known = {row[0] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    if not {f"run={run}" for run in runs} <= known:
        spark.catalog.recoverPartitions(name)
    return spark.table(name).where(F.col("run").isin(runs))


def _catalog_name(spark: SparkSession, table: KeyedTable) -> str:
    """The table's name in this session's catalog, which Spark's bucketed scans need."""
    layout = f"{table.path} {table.key} {table.buckets} {table.schema.json()}"
    name = "keyed_" + hashlib.sha256(layout.encode()).hexdigest()[:32]
    if not spark.catalog.tableExists(name):
        columns = T.StructType([*table.schema.fields, T.StructField("run", T.StringType())])
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns.toDDL()}) USING parquet PARTITIONED BY (run)"
            f" CLUSTERED BY (`{table.key}`) INTO {table.buckets} BUCKETS LOCATION '{table.path}/data'"
        )
    return name


def manifest(spark: SparkSession, table: KeyedTable) -> dict[str, int]:
    """The runs that count and their tiers: at most `fan_in` for each tier."""
    folder = versions.current(spark, f"{table.path}/manifest")
    if folder is None:
        return {}
    rows = spark.read.schema(_MANIFEST).parquet(folder).collect()
    if {row.buckets for row in rows} - {table.buckets}:
        raise ValueError(f"{table.path} has {rows[0].buckets} buckets, not {table.buckets}")
    return {row.run: row.tier for row in rows}


def _publish(spark: SparkSession, table: KeyedTable, runs: dict[str, int]) -> None:
    rows = spark.createDataFrame([(r, t, table.buckets) for r, t in runs.items()], _MANIFEST)
    versions.publish(
        spark, f"{table.path}/manifest", lambda folder: rows.coalesce(1).write.parquet(folder)
    )


def _write_run(rows: DataFrame, table: KeyedTable, label: str) -> str:
    """Write a run under a name of its own, so that nothing is ever written over: what a failed
    attempt leaves is never named by a manifest."""
    run = f"{label}-{uuid.uuid4().hex}"
    name = _catalog_name(rows.sparkSession, table)
    rows.withColumn("run", F.lit(run)).write.mode("append").insertInto(name)
    return run


def bucket_writer(table: KeyedTable) -> Callable[[DataFrame, int], None]:
    """Batch function that adds a micro-batch as a run and merges tiers that are full. A batch
    that is repeated after it was published changes nothing that readers see."""

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream:
            raise RuntimeError("bucket_writer runs inside a streaming query only")
        label = f"{stream}-{epoch}"
        with _turn:
            runs = manifest(spark, table)
            if any(run.startswith(f"{label}-") for run in runs):
                return
            rows = conform(batch, table.schema).repartition(table.buckets, table.key)
            _publish(spark, table, runs | {_write_run(rows, table, label): 0})
            merge_tiers(spark, table)

    return write


def merge_tiers(spark: SparkSession, table: KeyedTable) -> None:
    """Merge every tier that has `fan_in` runs into one run of the next, lowest tier first."""
    with _turn:
        runs, tier = manifest(spark, table), 0
        while tier <= max(runs.values(), default=-1):
            full = [run for run, t in runs.items() if t == tier]
            if len(full) >= table.fan_in:
                newest = latest(_stored(spark, table, full), table.schema, table.key)
                merged = _write_run(newest, table, "merged")
                runs = {run: t for run, t in runs.items() if run not in full} | {merged: tier + 1}
                _publish(spark, table, runs)
            tier += 1


def upsert_buckets(
    rows: DataFrame, table: KeyedTable, checkpoint: str, interval: str | None = INTERVAL
):
    return each_batch(rows, bucket_writer(table), checkpoint, interval)


def read_buckets(spark: SparkSession, table: KeyedTable) -> DataFrame:
    """One row for each id, the one written last, without columns that start with an underscore."""
    runs = manifest(spark, table)
    if not runs:
        return visible(spark.createDataFrame([], table.schema))
    return visible(latest(_stored(spark, table, list(runs)), table.schema, table.key))


def forget(spark: SparkSession, table: KeyedTable) -> None:
    """Delete runs that the manifest does not name. No reader may have begun before the last
    merge and still be reading."""
    with _turn:
        runs = {f"run={run}" for run in manifest(spark, table)}
        versions.forget(spark, f"{table.path}/manifest", keep=1)
        files, data = hadoop_path(spark, f"{table.path}/data")
        if not files.exists(data):
            return
        for status in files.listStatus(data):
            name = status.getPath().getName()
            if name.startswith("run=") and name not in runs:
                spark.sql(
                    f"ALTER TABLE {_catalog_name(spark, table)} DROP IF EXISTS"
                    f" PARTITION (run = '{name[4:]}')"
                )
                files.delete(status.getPath(), True)
