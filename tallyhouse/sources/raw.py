"""Append-only tables on parquet, one folder per ingest batch."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from tallyhouse.session import child_names

PARTITIONS = [StructField("load_date", DateType()), StructField("ingest_batch", StringType())]


def append_batch(rows: DataFrame, path: str, ingest_batch: str, partitions: list[str]) -> None:
    """Write the rows of one batch; writing the same batch again replaces it."""
    (
        rows.withColumn("ingest_batch", F.lit(ingest_batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions, "ingest_batch")
        .parquet(path)
    )


def append_raw(rows: DataFrame, path: str, ingest_batch: str) -> None:
    """Append raw rows, in folders by load date so that later reads skip old loads."""
    dated = rows.withColumn("load_date", F.to_date("loaded_at"))
    append_batch(dated, path, ingest_batch, ["load_date"])


def read_raw(
    spark: SparkSession, path: str, schema: StructType, since: dt.date | None = None
) -> DataFrame:
    """The raw table with its folder columns; empty if nothing has landed yet.

    With `since` only the folders of load dates from then on are listed, so a run that takes the
    newest load does not walk the folders of all loads before it.
    """
    full = StructType(schema.fields + PARTITIONS)
    days = child_names(spark, path, "load_date=*")
    if since is not None:
        days = [day for day in days if day >= f"load_date={since}"]
    if not days:
        return spark.createDataFrame([], full)
    reader = spark.read.schema(full)
    if since is None:
        return reader.parquet(path)
    return reader.option("basePath", path).parquet(*[f"{path}/{day}" for day in days])
