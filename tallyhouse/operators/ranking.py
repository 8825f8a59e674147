"""Top rows per group, newest values, running totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nulls_lead(nulls_rank: str) -> bool:
    if nulls_rank not in ("first", "last"):
        raise ValueError("nulls_rank is 'first' or 'last'")
    return nulls_rank == "first"


def descending(name: str, nulls_rank: str = "first") -> Column:
    """Descending order with NULLs ranked as the largest value, or last on request."""
    return F.desc_nulls_first(name) if nulls_lead(nulls_rank) else F.desc_nulls_last(name)


def top_one(df: DataFrame, group: str, measure: str, tie: str, nulls_rank: str = "first") -> DataFrame:
    """The row with the largest measure per group; the smallest `tie` value among equals."""
    window = Window.partitionBy(group).orderBy(descending(measure, nulls_rank), F.asc(tie))
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def top_n_dense(
    df: DataFrame,
    group: str,
    measure: str,
    n: int,
    rank: str = "ranking",
    nulls_rank: str = "first",
    max_groups: int | None = None,
) -> DataFrame:
    """All rows whose measure is among the `n` largest distinct values of their group.

    Only distinct (group, measure) pairs are ranked and then joined back on the pair, so rows that
    tie never meet in one task however many they are. The ranked pairs number at most `n` per
    group; they are broadcast only if `max_groups` states a small bound for the groups.
    """
    window = Window.partitionBy("_group").orderBy(descending("_measure", nulls_rank))
    levels = (
        df.select(F.col(group).alias("_group"), F.col(measure).alias("_measure"))
        .distinct()
        .withColumn(rank, F.row_number().over(window))
        .filter(F.col(rank) <= n)
    )
    if max_groups is not None and max_groups * n <= 10_000:
        levels = F.broadcast(levels)
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col(measure).eqNullSafe(F.col("_measure"))
    return df.join(levels, same).drop("_group", "_measure")


def newest_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The `n` largest distinct values of a column."""
    return df.select(column).distinct().orderBy(F.desc_nulls_first(column)).limit(n)


def newest_rows(df: DataFrame, column: str, n: int | None) -> DataFrame:
    """The first `n` rows by a column, newest first; all rows without `n`."""
    ordered = df.orderBy(F.desc_nulls_first(column))
    return ordered.limit(n) if n else ordered


def month_running_total(df: DataFrame, day: str, amount: str, total: str) -> DataFrame:
    """Running sum of `amount` from the first to the current day of each month."""
    window = (
        Window.partitionBy(F.trunc(day, "MM"))
        .orderBy(day)
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(total, F.sum(amount).over(window))
