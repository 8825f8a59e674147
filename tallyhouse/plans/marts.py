"""Reports over the stage tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.incremental import since
from tallyhouse.operators.ranking import (
    month_running_total,
    newest_rows,
    newest_values,
    nulls_lead,
    top_n_dense,
    top_one,
)
from tallyhouse.schemas import MEAN, MONEY, REPORT_DAILY_SALES, REPORT_LIFECYCLE, REPORT_TOP_STORES

# Report sizes and lookback windows in days.
REPORT_ROWS = 40
TOP_STORES = 5
TOP_STORE_DATES = 10
DAILY_LOOKBACK_DAYS = 7
LIFECYCLE_LOOKBACK_DAYS = 3


def _snapshot(as_of: dt.date | None) -> Column:
    return F.lit(as_of) if as_of else F.current_date()


def daily_store_sales(sales: DataFrame) -> DataFrame:
    """Total per day and store. Sums are built inside each task first, so busy stores do not weigh."""
    return (
        sales.filter(F.col("transaction_time").isNotNull())
        .groupBy(F.to_date("transaction_time").alias("transaction_date"), "store_token")
        .agg(F.sum("amount").alias("store_daily_sales"))
    )


def _day_metrics() -> list[Column]:
    """The input has one row per day and store, so counting rows counts distinct stores."""
    return [
        F.count("store_token").alias("active_stores"),
        F.sum("store_daily_sales").cast(MONEY).alias("total_amount"),
        F.avg("store_daily_sales").cast(MEAN).alias("avg_store_sales"),
    ]


def daily_stats(store_days: DataFrame) -> DataFrame:
    """Stores, total and mean store total per day."""
    return store_days.groupBy("transaction_date").agg(*_day_metrics())


def top_store_per_day(store_days: DataFrame, nulls_rank: str = "first") -> DataFrame:
    """The store with the largest total per day; the smallest token among equals."""
    best = top_one(store_days, "transaction_date", "store_daily_sales", "store_token", nulls_rank)
    return best.select("transaction_date", "store_token")


def daily_summary(store_days: DataFrame, nulls_rank: str = "first") -> DataFrame:
    """`daily_stats` with the top store of each day, in one aggregation.

    The smallest of (NULL flag, negated total, token) is the top store, so the two results need
    neither a second pass over the store days nor a join.
    """
    total = F.col("store_daily_sales")
    null_flag = total.isNotNull() if nulls_lead(nulls_rank) else total.isNull()
    best = F.min(F.struct(null_flag.alias("flag"), (-total).alias("total"), F.col("store_token")))
    return store_days.groupBy("transaction_date").agg(
        *_day_metrics(), best["store_token"].alias("top_store_token")
    )


def report_daily_sales(
    sales: DataFrame,
    as_of: dt.date | None = None,
    lookback_start: DataFrame | dt.date | None = None,
    month_anchored: bool = True,
    nulls_rank: str = "first",
    limit: int | None = REPORT_ROWS,
    seed: DataFrame | None = None,
) -> DataFrame:
    """Daily totals, running month total and top store, newest days first.

    With `lookback_start`, a day or a one-row frame with column `start`, only days from then on are
    produced, all of them: `limit` is one of the whole report, and days beyond it would be missing from the table
    that the rows go to. The running total then still begins on the first of the month, unless
    `month_anchored` is off: then it begins at the lookback start. With `seed`, the report as it stands, only days from the start on
    are read, and the total goes on from the report's last day before it; corrections of days before the start are then not in it.
    """
    if lookback_start is None:
        scanned = sales
    elif seed is not None:
        scanned, month_anchored = since(sales, "transaction_time", lookback_start), False
    elif not month_anchored:
        scanned = since(sales, "transaction_time", lookback_start)
    elif isinstance(lookback_start, DataFrame):
        scanned = since(sales, "transaction_time", lookback_start.select(F.trunc("start", "MM").alias("start")))
    else:
        scanned = since(sales, "transaction_time", lookback_start.replace(day=1))
    days = daily_summary(daily_store_sales(scanned), nulls_rank)
    report = month_running_total(days, "transaction_date", "total_amount", "running")
    if lookback_start is not None and seed is not None:
        report = report.withColumn("running", _with_seed(report.sparkSession, lookback_start, seed))
    report = report.withColumns(
        {"monthly_cumulative_sales": F.col("running").cast(MONEY), "snapshot_date": _snapshot(as_of)}
    ).select(*REPORT_DAILY_SALES.fieldNames())
    if lookback_start is not None and month_anchored:
        report = since(report, "transaction_date", lookback_start)
    return newest_rows(report, "transaction_date", limit if lookback_start is None else None)


def _with_seed(spark: SparkSession, lookback_start: DataFrame | dt.date, seed: DataFrame) -> Column:
    """The running total of the days in the start's month, with what the report held on its last day before the start."""
    if not isinstance(lookback_start, DataFrame):
        lookback_start = spark.createDataFrame([(lookback_start,)], "start date")
    first = lookback_start.agg(F.max("start").alias("start"))
    start, month = first.select("start").scalar(), first.select(F.trunc("start", "MM")).scalar()
    before = seed.where((F.col("transaction_date") >= month) & (F.col("transaction_date") < start))
    held = before.agg(F.max_by("monthly_cumulative_sales", "transaction_date").alias("held")).scalar()
    carried = F.when(F.trunc("transaction_date", "MM") == month, F.coalesce(held, F.lit(0))).otherwise(F.lit(0))
    return F.col("running") + carried


def sales_with_stores(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Sales with the name of their store, NULL for an unknown store."""
    names = stores.select("store_token", "store_name")
    return sales.join(names, "store_token", "left")


def last_dates(sales: DataFrame, n: int = TOP_STORE_DATES) -> DataFrame:
    """The newest `n` days with a transaction."""
    dated = sales.filter(F.col("transaction_time").isNotNull())
    days = dated.select(F.to_date("transaction_time").alias("transaction_date"))
    return newest_values(days, "transaction_date", n)


def report_top_stores(
    sales: DataFrame,
    stores: DataFrame,
    as_of: dt.date | None = None,
    top: int = TOP_STORES,
    dates: int = TOP_STORE_DATES,
    nulls_rank: str = "first",
) -> DataFrame:
    """The best stores of each of the newest days with sales; stores with equal totals share a rank.

    The newest days are exactly the days from the oldest of them on, so they reach the scan as a
    lower bound. Names are joined to the ranked rows only: `stores` holds one row per token.
    """
    start = last_dates(sales, dates).agg(F.min("transaction_date").alias("start"))
    recent = daily_store_sales(since(sales, "transaction_time", start))
    ranked = top_n_dense(
        recent, "transaction_date", "store_daily_sales", top, "range_top_id", nulls_rank, max_groups=dates
    )
    report = sales_with_stores(ranked, stores).withColumns(
        {"total_sales": F.col("store_daily_sales").cast(MONEY), "snapshot_date": _snapshot(as_of)}
    )
    ordered = report.select(*REPORT_TOP_STORES.fieldNames())
    return ordered.orderBy(F.desc_nulls_first("transaction_date"), "range_top_id", "store_token")


def raw_batch_stats(raw_sales: DataFrame) -> DataFrame:
    """Landed rows per batch date, headers included."""
    return raw_sales.groupBy("batch_date").agg(F.count("*").alias("total_raw_rows"))


def valid_batch_stats(sales: DataFrame) -> DataFrame:
    """Current stage rows per batch date and their newest load time."""
    return sales.groupBy("batch_date").agg(
        F.count("*").alias("total_valid_rows"), F.max("loaded_at").alias("processing_date")
    )


def join_batch_stats(raw_stats: DataFrame, valid_stats: DataFrame) -> DataFrame:
    """Raw, valid and ignored rows per batch date, from either side."""
    r, v = raw_stats.alias("r"), valid_stats.alias("v")
    raw_rows = F.coalesce("total_raw_rows", F.lit(0))
    valid_rows = F.coalesce("total_valid_rows", F.lit(0))
    return r.join(v, F.col("r.batch_date") == F.col("v.batch_date"), "full_outer").select(
        F.coalesce("r.batch_date", "v.batch_date").alias("batch_date"),
        raw_rows.alias("total_raw_rows"),
        valid_rows.alias("total_valid_rows"),
        (raw_rows - valid_rows).alias("total_ignored_rows"),
        "processing_date",
    )


def report_transactions_lifecycle(
    raw_sales: DataFrame,
    sales: DataFrame,
    as_of: dt.date | None = None,
    lookback_start: DataFrame | dt.date | None = None,
    limit: int | None = REPORT_ROWS,
) -> DataFrame:
    """Raw, valid and ignored rows per batch date, newest batches first.

    `limit` is one of the whole report; under a lookback every batch date from the start on is produced. A lookback is put on
    both inputs: Spark does not push it below the full join by itself, and the joined batch date is on or after the start exactly when the input's is.
    """
    if lookback_start is not None:
        raw_sales = since(raw_sales, "batch_date", lookback_start)
        sales = since(sales, "batch_date", lookback_start)
    stats = raw_batch_stats(raw_sales), valid_batch_stats(sales)
    return lifecycle_of_counts(*stats, as_of, limit=limit if lookback_start is None else None)


def lifecycle_of_counts(
    raw_stats: DataFrame,
    valid_stats: DataFrame,
    as_of: dt.date | None = None,
    lookback_start: DataFrame | dt.date | None = None,
    limit: int | None = REPORT_ROWS,
) -> DataFrame:
    """The lifecycle report from counts per batch date that were kept up by every run."""
    if lookback_start is not None:
        raw_stats, valid_stats = (since(stats, "batch_date", lookback_start) for stats in (raw_stats, valid_stats))
    report = join_batch_stats(raw_stats, valid_stats)
    report = report.withColumn("snapshot_date", _snapshot(as_of)).select(*REPORT_LIFECYCLE.fieldNames())
    return newest_rows(report, "batch_date", limit if lookback_start is None else None)
