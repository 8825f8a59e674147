"""High-water mark, lookback and keyed upsert."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.clock import clock_literal

# Fixed value: earliest date, the lower bound when a target is empty.
FIRST_DAY = "0001-01-01"


def high_water_mark(target: DataFrame, column: str = "loaded_at") -> DataFrame:
    """One row with the largest value of the column; NULL on an empty target."""
    return target.agg(F.max(column).alias("high_water"))


def high_water_filter(
    source: DataFrame,
    mark: DataFrame | dt.datetime | None,
    column: str = "loaded_at",
    day_partition: str | None = None,
) -> DataFrame:
    """Rows newer than the mark; all rows when there is no mark.

    `mark` is a value, or the one-row result of `high_water_mark`, which stays in the plan as a
    scalar subquery and reaches the scan as a filter; over an empty target it admits every row with
    a load time. `day_partition` names a partition column that holds the day of `column`: with a
    value as mark it also prunes folders.
    """
    if mark is None:
        return source
    if isinstance(mark, DataFrame):
        earliest = clock_literal(FIRST_DAY)
        bound = mark.agg(F.coalesce(F.max("high_water"), earliest).alias("high_water")).scalar()
        return source.filter(F.col(column) > bound)
    kept = source.filter(F.col(column) > clock_literal(mark))
    if day_partition:
        kept = kept.filter(F.col(day_partition) >= F.lit(mark.date()))
    return kept


def lookback_start(target: DataFrame, day: str, days: int) -> DataFrame:
    """One row: the newest day of the target minus `days`; the earliest date on an empty target."""
    return target.agg(F.coalesce(F.date_add(F.max(day), -days), F.lit(FIRST_DAY).cast("date")).alias("start"))


def since(source: DataFrame, column: str, start: DataFrame | dt.date) -> DataFrame:
    """Rows whose date or timestamp is on or after the start day.

    The bound is brought to the column's type on its own side, so the comparison reaches the scan.
    """
    kind = source.schema[column].dataType
    if isinstance(start, DataFrame):
        bound: Column = start.select(F.max("start").cast(kind).alias("start")).scalar()
    else:
        bound = F.lit(start).cast(kind)
    return source.filter(F.col(column) >= bound)


def upsert(
    target: DataFrame, delta: DataFrame, keys: list[str], null_safe_keys: bool = False
) -> DataFrame:
    """Replace target rows whose key is in the delta, add the rest; nothing is deleted.

    A NULL key matches nothing unless `null_safe_keys` is set. The delta is read twice, so pass one
    that is a table already if it is dear to compute.
    """
    new_keys = delta.select([F.col(k).alias(f"_new_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        match = F.col(k).eqNullSafe(F.col(f"_new_{k}")) if null_safe_keys else F.col(k) == F.col(f"_new_{k}")
        same = same & match
    return target.join(new_keys, same, "left_anti").unionByName(delta)
