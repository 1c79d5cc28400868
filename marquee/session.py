"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_local_scratch: tempfile.TemporaryDirectory | None = None
_scratch_paths: list[str] = []
_stored: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(name: str = "marquee", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings this library is written for; `conf` overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by `spark.checkpoint.dir`.

    Only a local-mode session may go without the setting: driver and executors are then one
    process, so a temporary folder of this machine is shared by all of them.
    """
    global _local_scratch
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_scratch is None:
        _local_scratch = tempfile.TemporaryDirectory(prefix="marquee-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(_local_scratch.name + "/checkpoints")
    return _local_scratch.name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _scratch_paths.append(path)
    return path


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this process has written to scratch paths. Frames that were derived from it
    can no longer be computed, so results come first."""
    while _scratch_paths:
        files, target = hadoop_path(spark, _scratch_paths.pop())
        files.delete(target, True)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each query that ends within are deleted at its end. The engine would keep
    them until the driver happens to collect its garbage, so those of many steps add up on disk.

    Frames that are returned to the caller run outside and keep theirs.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once as a table in the shared folder and read it back.

    Cuts the lineage, and fixes values that depend on how rows were partitioned, so that a later
    loss of executors cannot change them. Its shuffles are deleted once it is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with freed_shuffles(spark):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _stored[table] = path
    return table


def discard_table(table: DataFrame) -> None:
    """Delete what `materialize` has written, once no later step reads it."""
    discard(table.sparkSession, _stored.pop(table))


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch path that no later step reads."""
    files, target = hadoop_path(spark, path)
    files.delete(target, True)
    if path in _scratch_paths:
        _scratch_paths.remove(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether `path` exists in the file system its own URI scheme names."""
    files, target = hadoop_path(spark, path)
    return bool(files.exists(target))


def hadoop_path(spark: SparkSession, path: str):
    """The file system that the path's URI scheme names, and the path in it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target
