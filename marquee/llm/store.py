"""Tables between the steps of an operator, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marquee.session import discard, freed_shuffles, scratch_path


class Store:
    """Writes frames to the folder named by `spark.checkpoint.dir` and reads them back.

    A written table cuts the lineage and fixes what depends on task order, so a lost executor
    costs only its own tasks; its shuffles are deleted once it is written. `drop` deletes a table
    that no later step reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.label = label
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def keep(self, df: DataFrame, label: str, schema: T.StructType | None = None) -> DataFrame:
        """`schema` may name other types of the same stored form."""
        path = scratch_path(self.spark, f"{self.label}-{label}")
        with freed_shuffles(self.spark):
            df.write.parquet(path)
        table = self.spark.read.schema(schema or df.schema).parquet(path)
        self._paths[id(table)] = (table, path)
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            _, path = self._paths.pop(id(table))
            discard(self.spark, path)
