"""Column checks on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

#: Columns of the raw tables that should hold something.
NOT_NULL = {"sales": ["store_token", "transaction_id"], "stores": ["store_token"]}
NULL_COUNTS = "table_name string, column_name string, row_count long, failures long"


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column with its count of NULLs, from one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "failures")


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are not counted."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("occurrences"))
        .filter("occurrences > 1")
    )


def unique(df: DataFrame, column: str) -> DataFrame:
    """One row: the column and the number of values that occur more than once."""
    return duplicates(df, column).agg(
        F.lit(column).alias("column_name"), F.count("*").alias("failures")
    )


def counted_on_the_way(df: DataFrame, columns: list[str]) -> tuple[DataFrame, Observation]:
    """The rows, and their number and that of NULLs per column, to be had once they have been written."""
    seen = Observation()
    counts = [F.count_if(F.col(c).isNull()).alias(f"null_{k}") for k, c in enumerate(columns)]
    return df.observe(seen, F.count(F.lit(1)).alias("row_count"), *counts), seen


def null_counts(seen: Observation, table: str, columns: list[str]) -> list[tuple]:
    """What was counted, as rows of NULL_COUNTS."""
    found = seen.get
    return [(table, column, found["row_count"], found[f"null_{k}"]) for k, column in enumerate(columns)]
