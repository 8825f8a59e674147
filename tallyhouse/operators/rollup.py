"""Counts per batch date that are kept up by what comes and goes, so that a report need not count its tables again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import delete_path, path_exists

COUNTS = "batch_date date, loaded_at timestamp_ntz, valid_rows long"
#: What the stage versions' counts need to know of a row.
WATCHED = ("batch_date", "loaded_at")
WHOLE = "whole"


def signed_counts(changes: DataFrame) -> DataFrame:
    """Versions that came less versions that went, per batch date and load."""
    return changes.groupBy(*WATCHED).agg(F.sum("sign").cast("long").alias("valid_rows"))


def valid_stats(counts: DataFrame) -> DataFrame:
    """Current rows per batch date and their newest load, from signed counts: the newest load is one that still has rows."""
    held = counts.groupBy(*WATCHED).agg(F.sum("valid_rows").alias("n")).where("n > 0")
    return held.groupBy("batch_date").agg(F.sum("n").alias("total_valid_rows"), F.max("loaded_at").alias("processing_date"))


def raw_load_counts(raw: DataFrame) -> DataFrame:
    """Landed rows per batch date and load; a load is complete when it is seen, so its counts are final."""
    return raw.groupBy("batch_date", "loaded_at").agg(F.count("*").alias("raw_rows"))


def raw_stats(counts: DataFrame) -> DataFrame:
    """Landed rows per batch date."""
    return counts.groupBy("batch_date").agg(F.sum("raw_rows").alias("total_raw_rows"))


class SignedCounts:
    """The signed counts of a table's runs, a folder per run: a run that is done again replaces its own counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def complete(self) -> bool:
        """Whether the counts go back to a count of the whole table."""
        return path_exists(self.spark, f"{self.path}/run={WHOLE}")

    def read(self) -> DataFrame:
        return self.spark.read.schema(f"{COUNTS}, run string").parquet(self.path).drop("run")

    def add(self, run: str, changes: DataFrame) -> None:
        signed_counts(changes).write.mode("overwrite").parquet(f"{self.path}/run={run}")

    def forget(self) -> None:
        delete_path(self.spark, self.path)

    def count_whole(self, table: DataFrame) -> None:
        """Begin anew from the rows of a whole table."""
        self.forget()
        self.add(WHOLE, table.select(*WATCHED, F.lit(1).alias("sign")))
