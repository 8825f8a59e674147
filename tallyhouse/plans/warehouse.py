"""Keeps the stage tables and reports of one root folder up to date."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.incremental import high_water_filter
from tallyhouse.operators.quality import NOT_NULL, not_null, unique
from tallyhouse.operators.rollup import WATCHED, SignedCounts, raw_load_counts, raw_stats, valid_stats
from tallyhouse.plans import marts
from tallyhouse.plans.landing import land_files, read_null_counts
from tallyhouse.plans.stage import stage_sales, stage_stores
from tallyhouse.schemas import (
    RAW_LOADS,
    RAW_SALES,
    RAW_STORES,
    REPORT_DAILY_SALES,
    REPORT_LIFECYCLE,
    REPORT_TOP_STORES,
    SALES_KEYS,
    STAGE_SALES,
    STAGE_STORES,
    STORES_KEYS,
)
from tallyhouse.sources.keyed import KeyedTable
from tallyhouse.sources.raw import read_raw


@dataclass(frozen=True)
class Warehouse:
    """Raw, stage and report layers below `root`.

    Stage runs take what landed after the newest staged load time. Reports look back a few days behind their newest row.
    `full_refresh` rebuilds from the whole layer below. `buckets` is the number of parts by key of the stage of sales; it stays
    what it was when that table was first written.
    """

    spark: SparkSession
    root: str
    timestamp_formats: list[str] | None = None
    buckets: int = 8

    def raw_sales(self, since: dt.date | None = None) -> DataFrame:
        return read_raw(self.spark, f"{self.root}/raw/sales", RAW_SALES, since)

    def raw_stores(self, since: dt.date | None = None) -> DataFrame:
        return read_raw(self.spark, f"{self.root}/raw/stores", RAW_STORES, since)

    @property
    def sales(self) -> KeyedTable:
        path = f"{self.root}/stage/sales"
        return KeyedTable(self.spark, path, STAGE_SALES, SALES_KEYS, "loaded_at", "transaction_time", self.buckets, watched=WATCHED)

    @property
    def stores(self) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/stage/stores", STAGE_STORES, STORES_KEYS, "loaded_at")

    @property
    def sales_counts(self) -> SignedCounts:
        return SignedCounts(self.spark, f"{self.root}/stage/sales_counts")

    @property
    def raw_loads(self) -> KeyedTable:
        path = f"{self.root}/stage/raw_loads"
        return KeyedTable(self.spark, path, RAW_LOADS, ["batch_date", "loaded_at"], "loaded_at", "batch_date", null_safe_keys=True)

    @property
    def daily_sales(self) -> KeyedTable:
        path = f"{self.root}/marts/report_daily_sales"
        return KeyedTable(self.spark, path, REPORT_DAILY_SALES, ["transaction_date"], month_of="transaction_date")

    @property
    def top_stores(self) -> KeyedTable:
        path = f"{self.root}/marts/report_top_stores"
        return KeyedTable(self.spark, path, REPORT_TOP_STORES, ["transaction_date", "store_token"])

    @property
    def lifecycle(self) -> KeyedTable:
        path = f"{self.root}/marts/report_transactions_lifecycle"
        return KeyedTable(self.spark, path, REPORT_LIFECYCLE, ["batch_date"], month_of="batch_date")

    def land(
        self,
        inbox: str,
        run_date: dt.date | None = None,
        archive: bool = False,
        strict: bool = False,
        move_to: str | None = None,
        multiline: bool = False,
    ) -> list[str]:
        return land_files(
            self.spark, inbox, self.root, run_date, archive, strict=strict, move_to=move_to, multiline=multiline
        )

    def check(self, layer: str | None = None) -> DataFrame:
        """Failures of the column checks, one row per check.

        By default missing values are those that landing counted while it wrote the raw layer, as staging leaves out rows without a store, and repeated
        stores in the stage layer, as stores are sent again when they change. `layer`, "stage" or "raw", runs all
        checks on one of the two.
        """
        if layer not in ("stage", "raw", None):
            raise ValueError("layer is 'stage', 'raw' or None")
        first, second = layer or "raw", layer or "stage"
        counted = read_null_counts(self.spark, self.root) if first == "raw" else None
        if counted is None:
            sales = self.sales.read() if first == "stage" else self.raw_sales()
            stores = self.stores.read() if first == "stage" else self.raw_stores()
            found = [(table, not_null(rows, NOT_NULL[table])) for table, rows in (("sales", sales), ("stores", stores))]
        else:
            found = [(table, counted.where(F.col("table_name") == table)) for table in NOT_NULL]
        checks = [(table, "not_null", rows) for table, rows in found]
        checks.append(("stores", "unique", unique(self.stores.read() if second == "stage" else self.raw_stores(), "store_token")))
        named = [
            found.select(F.lit(table).alias("table_name"), "column_name", F.lit(kind).alias("check"), "failures")
            for table, kind, found in checks
        ]
        return reduce(DataFrame.unionByName, named)

    def _new_raw(self, table: KeyedTable, read, full_refresh: bool) -> DataFrame:
        """Raw rows that landed after the table's newest load; all of them for a first run or a full refresh."""
        mark = None if full_refresh else table.high_water()
        return high_water_filter(read(mark.date() if mark else None), mark, "loaded_at", "load_date")

    def run_stage(self, full_refresh: bool = False) -> None:
        sales, stores, counts, loads = self.sales, self.stores, self.sales_counts, self.raw_loads
        for table in (sales, stores, loads):
            table.recover(counts.add if table is sales else None)
        rows = stage_sales(self._new_raw(sales, self.raw_sales, full_refresh), timestamp_formats=self.timestamp_formats)
        if full_refresh or not sales.exists() or not counts.complete():
            counts.forget()
            if full_refresh or not sales.exists():
                sales.replace(rows)
            else:
                sales.upsert(rows)
            counts.count_whole(sales.read())
        else:
            sales.upsert(rows, counts.add)
        for table, new in (
            (stores, stage_stores(self._new_raw(stores, self.raw_stores, full_refresh))),
            (loads, raw_load_counts(self._new_raw(loads, self.raw_sales, full_refresh))),
        ):
            if full_refresh:
                table.replace(new)
            else:
                table.upsert(new)

    def _start(self, report: KeyedTable, day: str, days: int, full_refresh: bool) -> dt.date | None:
        """First day of the lookback; None for a first run, an empty report or a full refresh."""
        if full_refresh:
            return None
        newest = report.read().agg(F.max(day)).first()[0]
        return None if newest is None else newest - dt.timedelta(days=days)

    def _merge(self, report: KeyedTable, rows: DataFrame, start: dt.date | None) -> None:
        """A first run writes the report whole, a lookback its days."""
        if start is None:
            report.replace(rows)
        else:
            report.upsert(rows)

    def run_daily_sales(
        self, as_of: dt.date | None = None, full_refresh: bool = False, month_anchored: bool = True, seeded: bool = False
    ) -> None:
        """`seeded` carries the running total on from the report's last day before the lookback and reads no day before it."""
        start = self._start(self.daily_sales, "transaction_date", marts.DAILY_LOOKBACK_DAYS, full_refresh)
        scan_from = start.replace(day=1) if start and month_anchored and not seeded else start
        seed = self.daily_sales.read() if start and seeded else None
        rows = marts.report_daily_sales(self.sales.read(scan_from), as_of, start, month_anchored, seed=seed)
        self._merge(self.daily_sales, rows, start)

    def _recent_sales(self, dates: int) -> DataFrame:
        """Sales that hold the newest `dates` days, read from as late a day as is safe.

        The daily report suggests the day. If fewer days have sales from there on, as when a
        correction emptied one, the whole table is read.
        """
        days = self.daily_sales.read().select("transaction_date").orderBy(F.desc("transaction_date"))
        start, found = days.limit(dates).agg(F.min("transaction_date"), F.count("*")).first()
        if found == dates:
            recent = self.sales.read(start)
            if marts.last_dates(recent, dates).count() == dates:
                return recent
        return self.sales.read()

    def run_top_stores(self, as_of: dt.date | None = None) -> None:
        recent = self._recent_sales(marts.TOP_STORE_DATES)
        self.top_stores.replace(marts.report_top_stores(recent, self.stores.read(), as_of))

    def run_lifecycle(self, as_of: dt.date | None = None, full_refresh: bool = False) -> None:
        """From the counts that stage runs keep: neither the raw nor the stage layer is read."""
        start = self._start(self.lifecycle, "batch_date", marts.LIFECYCLE_LOOKBACK_DAYS, full_refresh)
        landed, valid = raw_stats(self.raw_loads.read()), valid_stats(self.sales_counts.read())
        self._merge(self.lifecycle, marts.lifecycle_of_counts(landed, valid, as_of, start), start)

    def run(self, as_of: dt.date | None = None, full_refresh: bool = False) -> None:
        """Stage tables first, then the three reports."""
        self.run_stage(full_refresh)
        self.run_daily_sales(as_of, full_refresh)
        self.run_top_stores(as_of)
        self.run_lifecycle(as_of, full_refresh)
