"""Stage tables and reports kept current by micro-batches of raw rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallyhouse.operators.dedup import newest_by_aggregate
from tallyhouse.operators.rollup import raw_load_counts
from tallyhouse.plans import marts
from tallyhouse.session import child_names, delete_path
from tallyhouse.sources.keyed import KeyedTable, OnChange

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PARTITIONS = "spark.sql.shuffle.partitions"
STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
}
#: A run that ends with what is there does not leave a second copy of the state on the executors' disks.
UNLOAD = "spark.sql.streaming.stateStore.unloadOnCommit"


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]):
    """Streams that are started inside have these settings; a stream takes them over when it starts."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _start(
    spark: SparkSession,
    raw_path: str,
    raw_schema: StructType,
    build: Callable[[DataFrame], DataFrame],
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    max_files: int,
    once: bool,
    interval: str,
    buckets: int = 0,
) -> StreamingQuery:
    """The state is on disk, and lies by key in a multiple of `buckets` parts: each holds keys of one bucket only."""
    parts = int(spark.conf.get(PARTITIONS))
    settings = STATE | {UNLOAD: str(once).lower(), PARTITIONS: str(-(-parts // buckets) * buckets if buckets else parts)}
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    raw = spark.readStream.schema(raw_schema).option("maxFilesPerTrigger", max_files).parquet(raw_path)
    with _settings(spark, settings):
        return (
            build(raw)
            .writeStream.outputMode("update")
            .foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )


def start_upsert(
    spark: SparkSession,
    raw_path: str,
    raw_schema: StructType,
    table: KeyedTable,
    clean: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    max_files: int = 1000,
    once: bool = True,
    interval: str = "1 minute",
    on_change: OnChange | None = None,
    after: Callable[[], None] | None = None,
) -> StreamingQuery:
    """Keep the newest version of every key in the stream's state and bring what a batch changed into `table`.

    `clean` types the raw rows, one by one, and keeps their lineage. Rows that come after a newer version of their key change nothing,
    in whatever batch they come. A batch that is replayed writes the same rows again. NULL keys are one key, as in a full run.
    `on_change` gets the versions that come and go, `after` runs once a batch is in; both must bear being run twice.
    """
    target = replace(table, null_safe_keys=True)

    def write(batch: DataFrame, batch_id: int) -> None:
        target.upsert(batch, on_change, newest=True)
        if after is not None:
            after()

    def build(raw: DataFrame) -> DataFrame:
        return newest_by_aggregate(clean(raw), table.keys, table.mark_column)

    return _start(spark, raw_path, raw_schema, build, write, checkpoint, max_files, once, interval, table.buckets)


def start_raw_counts(
    spark: SparkSession,
    raw_path: str,
    raw_schema: StructType,
    loads: KeyedTable,
    checkpoint: str,
    max_files: int = 1000,
    once: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Keep the number of raw rows per batch date and load in `loads`."""
    target = replace(loads, null_safe_keys=True)

    def write(batch: DataFrame, batch_id: int) -> None:
        target.upsert(batch, newest=True)

    return _start(spark, raw_path, raw_schema, raw_load_counts, write, checkpoint, max_files, once, interval)


class DailyReport:
    """The daily report of a stage table, brought up to date month by month.

    The days of the versions that a batch brings and takes away say which months are computed anew, however late they are; a day that
    loses its last row leaves the report. The months are noted before the table changes and until the report has them.
    """

    def __init__(self, sales: KeyedTable, report: KeyedTable, as_of: dt.date | None = None):
        if "transaction_time" not in sales.watched:
            raise ValueError("the stage table has to watch transaction_time")
        self.sales, self.report, self.as_of = sales, report, as_of
        self.notes = f"{report.path}.touched"

    def on_change(self, run: str, changes: DataFrame) -> None:
        months = changes.select(F.trunc("transaction_time", "MM").alias("month")).where("month IS NOT NULL").distinct()
        months.coalesce(1).write.mode("overwrite").parquet(f"{self.notes}/run={run}")

    def after(self) -> None:
        spark = self.sales.spark
        runs = child_names(spark, self.notes, "run=*")
        if not runs:
            return
        noted = spark.read.schema("month date").parquet(*[f"{self.notes}/{run}" for run in runs])
        months = [row[0] for row in noted.distinct().collect()]
        if months:
            rows = marts.report_daily_sales(self.sales.read_months(months), self.as_of, limit=None)
            self.report.replace_months(rows, months)
        for run in runs:
            delete_path(spark, f"{self.notes}/{run}")
