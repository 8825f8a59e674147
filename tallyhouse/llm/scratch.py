"""Intermediate tables in the shared folder, so that a lost executor never means a lost result."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.session import delete_path, scratch_dir


class Scratch:
    """A folder of its own below `spark.checkpoint.dir` for the tables of one run.

    A table is written as Parquet and read again: that cuts the lineage, and its rows stay what
    they are when tasks are repeated. `drop` frees tables that later ones have replaced.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_dir(spark, label)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        for table in tables:
            if table is not None:
                delete_path(self.spark, table.scratch_path)
