"""One query per operator and report, each over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tallyhouse.checks import fixtures
from tallyhouse.checks.fixtures import AS_OF, SPLIT
from tallyhouse.functions.cleaning import clean_amount, null_tokens, parse_timestamp
from tallyhouse.functions.clock import clock_literal
from tallyhouse.functions.files import STORES, TRANSACTIONS, batch_date, in_inbox, route_file
from tallyhouse.operators import quality
from tallyhouse.operators.dedup import keep_latest
from tallyhouse.operators.incremental import high_water_filter, high_water_mark, lookback_start, upsert
from tallyhouse.operators.landing import (
    archive_rows,
    good_lines,
    ingest_log,
    is_bad_line,
    sales_rows,
    shift_roles,
    split_fields,
    split_line,
    stores_rows,
)
from tallyhouse.operators.ranking import month_running_total, top_n_dense
from tallyhouse.operators.rollup import SignedCounts, raw_load_counts, raw_stats, valid_stats
from tallyhouse.plans import marts
from tallyhouse.plans.landing import land_files, read_ledger
from tallyhouse.plans.stage import clean_sales, clean_stores, drop_headers, sales_versions, stage_sales, stage_stores
from tallyhouse.schemas import (
    RAW_LOADS,
    RAW_SALES,
    RAW_STORES,
    REPORT_DAILY_SALES,
    SALES_FIELDS,
    SALES_KEYS,
    STAGE_SALES,
    STORES_FIELDS,
    STORES_KEYS,
    create_raw_tables,
)
from tallyhouse.session import scratch_dir
from tallyhouse.sources.keyed import KeyedTable, buckets_for
from tallyhouse.sources.raw import read_raw
from tallyhouse.streaming.ingest import start_ingest
from tallyhouse.streaming.stage import DailyReport, start_raw_counts, start_upsert

# Day up to which the target of the lookback queries has been built.
BUILT_TO = dt.datetime(2001, 10, 10)
GAP_FROM = dt.datetime(2001, 6, 1)

Query = Callable[[SparkSession, str], DataFrame]


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as text: both engines hand over the same type, and every cent counts."""
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in df.schema
        ]
    )


def _stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_sales(fixtures.raw_sales(spark, sf_dir))


def _stage_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_stores(fixtures.raw_stores(spark, sf_dir))


def _store_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_store_sales(_stage(spark, sf_dir))


def _until(df: DataFrame, moment: dt.datetime) -> DataFrame:
    return df.filter(F.col("loaded_at") <= clock_literal(moment))


# Landing


def route_files(spark, sf_dir):
    names = fixtures.file_names(spark, sf_dir)
    return names.select("o_orderkey", "file_key", route_file(F.col("file_key")).alias("file_type"))


def inbox_filter(spark, sf_dir):
    return fixtures.file_names(spark, sf_dir).filter(in_inbox(F.col("file_key")))


def batch_date_extract(spark, sf_dir):
    names = fixtures.file_names(spark, sf_dir)
    return names.select("o_orderkey", batch_date(F.col("file_key"), AS_OF).alias("batch_date"))


def _accepted(lines: DataFrame, feed: str) -> DataFrame:
    return good_lines(lines, ingest_log(lines, AS_OF), feed)


def csv_scan(spark, sf_dir):
    lines = fixtures.sales_lines(spark, sf_dir)
    return lines.select(split_line(F.col("value"), 7).alias("f"), is_bad_line(F.col("value")).alias("bad")).select("f.*", "bad")


def null_token_values(spark, sf_dir):
    fields = split_line(F.col("value"), 3)
    lines = fixtures.sales_lines(spark, sf_dir)
    return lines.select(fields["c2"].alias("transaction_id"), null_tokens(fields["c3"]).alias("receipt_token"))


def sales_positional_shift(spark, sf_dir):
    shifted = shift_roles(split_fields(fixtures.sales_lines(spark, sf_dir), 7))
    return shifted.select(F.col("c2").alias("transaction_id"), "source_id", "user_role")


def bad_row_policy(spark, sf_dir):
    sales = _accepted(fixtures.sales_lines(spark, sf_dir), TRANSACTIONS)
    stores = _accepted(fixtures.store_lines(spark, sf_dir), STORES)
    kept = sales.select("file_path").unionByName(stores.select("file_path"))
    return kept.groupBy("file_path").agg(F.count("*").alias("kept_rows"))


def raw_sales(spark, sf_dir, drops=fixtures.FEW_BAD_DROPS_SQL):
    return sales_rows(_accepted(fixtures.sales_lines(spark, sf_dir, drops), TRANSACTIONS))


def raw_stores(spark, sf_dir, lines=fixtures.STORE_LINES_SQL):
    return stores_rows(_accepted(fixtures.store_lines(spark, sf_dir, lines), STORES))


def _all_lines(spark, sf_dir):
    """Sales and stores files, files of neither feed and files without a valid date."""
    stores = fixtures.store_lines(spark, sf_dir)
    path = F.col("file_path")
    unknown = stores.withColumn("file_path", F.replace(path, F.lit("stores"), F.lit("readme")))
    undated = stores.withColumn("file_path", F.replace(path, F.lit("stores_20250112"), F.lit("sales_99999999")))
    return fixtures.sales_lines(spark, sf_dir).unionByName(stores).unionByName(unknown).unionByName(undated)


def ingest_log_query(spark, sf_dir):
    return ingest_log(_all_lines(spark, sf_dir), AS_OF).drop("file_modified_at")


def history_partitions(spark, sf_dir):
    lines = _all_lines(spark, sf_dir)
    kept = archive_rows(lines, ingest_log(lines, AS_OF), F.col("loaded_at"))
    per_file = kept.groupBy("file_type", "year", "month", "day", "file_path").agg(F.count("*").alias("n"))
    return per_file.groupBy("file_type", "year", "month", "day").agg(
        F.count("*").alias("file_count"), F.sum("n").alias("line_count")
    )


def _write_inbox(spark, sf_dir, inbox):
    """Two sales drops, one with a blank in its name, a sales drop with all bad lines, which is turned away, and a stores drop."""
    lines = fixtures.sales_lines(spark, sf_dir)
    late = F.substring_index(F.col("value"), ",", 1).endswith("1")
    fixtures.write_drop(lines.filter(~late & ~F.col("bad")), inbox, "sales_20250111")
    fixtures.write_drop(lines.filter(late & ~F.col("bad")), inbox, "sales 20250112")
    fixtures.write_drop(lines.filter(F.col("bad")).repartition(1), inbox, "sales_20250113")
    fixtures.write_drop(fixtures.store_lines(spark, sf_dir), inbox, "stores_20250112")


def _landed(spark, root):
    return read_raw(spark, f"{root}/raw/sales", RAW_SALES).select(*SALES_FIELDS, "batch_date")


def file_lineage(spark, sf_dir):
    """Every landed row names a file of the ledger, its time and the load time of its batch."""
    root = scratch_dir(spark, "lineage")
    _write_inbox(spark, sf_dir, f"{root}/inbox")
    land_files(spark, f"{root}/inbox", root, AS_OF)
    known = read_ledger(spark, root).where("state = 'planned'").select(
        F.col("path").alias("source_filename"), "file_modified_at", "loaded_at", F.lit(True).alias("known")
    )
    drop = F.regexp_extract("source_filename", r"([a-z]+[ _]\d{8})[^/]*$", 1).alias("file_name")
    rows = read_raw(spark, f"{root}/raw/sales", RAW_SALES).select("source_filename", "file_modified_at", "loaded_at")
    rows = rows.unionByName(read_raw(spark, f"{root}/raw/stores", RAW_STORES).select(*rows.columns))
    joined = rows.join(known, ["source_filename", "file_modified_at", "loaded_at"], "left")
    return joined.groupBy(drop).agg(F.count("*").alias("row_count"), F.count("known").alias("known_rows"))


def raw_ddl(spark, sf_dir):
    """Raw rows inserted by name into the declared tables; those without a load time get one."""
    root = scratch_dir(spark, "ddl")
    name = f"tallyhouse_ddl_{root[-8:]}"
    create_raw_tables(spark, name, root)
    fields = [*SALES_FIELDS, "batch_date"]
    begin = F.current_timestamp()
    fixtures.raw_sales(spark, sf_dir).select(*fields).createOrReplaceTempView("tallyhouse_ddl_rows")
    names = ", ".join(fields)
    spark.sql(f"INSERT INTO {name}.sales ({names}) SELECT {names} FROM tallyhouse_ddl_rows")
    spark.catalog.dropTempView("tallyhouse_ddl_rows")
    fresh = F.abs(F.unix_timestamp(F.col("loaded_at").cast("timestamp")) - F.unix_timestamp(begin)) < 86400
    return spark.table(f"{name}.sales").select(*fields, fresh.alias("has_load_time"))


def csv_stream_ingest(spark, sf_dir):
    root = scratch_dir(spark, "stream-ingest")
    _write_inbox(spark, sf_dir, f"{root}/inbox")
    start_ingest(spark, f"{root}/inbox", root, f"{root}/checkpoint", AS_OF).awaitTermination()
    return _landed(spark, root)


def csv_batch_ingest(spark, sf_dir):
    root = scratch_dir(spark, "batch-ingest")
    _write_inbox(spark, sf_dir, f"{root}/inbox")
    land_files(spark, f"{root}/inbox", root, AS_OF)
    stores = read_raw(spark, f"{root}/raw/stores", RAW_STORES).select(*STORES_FIELDS, "batch_date")
    return _landed(spark, root).unionByName(stores, allowMissingColumns=True)


# Cleaning and staging


def header_filter(spark, sf_dir):
    kept = drop_headers(fixtures.raw_sales(spark, sf_dir))
    return kept.select("store_token", "transaction_id", "batch_date", "loaded_at")


def amount_clean(spark, sf_dir):
    raw = fixtures.raw_sales(spark, sf_dir)
    return raw.select("transaction_id", F.col("amount").alias("text"), clean_amount(F.col("amount")).alias("amount"))


def timestamp_parse(spark, sf_dir):
    text = F.col("transaction_time")
    raw = fixtures.raw_sales(spark, sf_dir)
    return raw.select("transaction_id", text.alias("text"), parse_timestamp(text).alias("transaction_time"))


def dedup_latest_sales(spark, sf_dir):
    latest = keep_latest(clean_sales(fixtures.raw_sales(spark, sf_dir)), SALES_KEYS)
    return latest.select("store_token", "transaction_id", "amount", "loaded_at")


def dedup_latest_stores(spark, sf_dir):
    latest = keep_latest(clean_stores(fixtures.raw_stores(spark, sf_dir)), STORES_KEYS)
    return latest.select("store_token", "store_name", "loaded_at")


# Reports and their parts


def daily_stats(spark, sf_dir):
    return marts.daily_stats(_store_days(spark, sf_dir))


def top_store_per_day(spark, sf_dir):
    return marts.top_store_per_day(_store_days(spark, sf_dir))


def monthly_running_total(spark, sf_dir):
    days = marts.daily_stats(_store_days(spark, sf_dir)).select("transaction_date", "total_amount")
    return month_running_total(days, "transaction_date", "total_amount", "monthly_cumulative_sales")


def report_daily_sales(spark, sf_dir):
    return marts.report_daily_sales(_stage(spark, sf_dir), AS_OF)


def sales_left_join_stores(spark, sf_dir):
    joined = marts.sales_with_stores(_stage(spark, sf_dir), _stage_stores(spark, sf_dir))
    return joined.select("store_token", "transaction_id", "store_name", "amount")


def top_n_dense_rank(spark, sf_dir):
    return top_n_dense(_store_days(spark, sf_dir), "transaction_date", "store_daily_sales", 5).withColumn(
        "ranking", F.col("ranking").cast("bigint")
    )


def last_10_dates(spark, sf_dir):
    return marts.last_dates(_stage(spark, sf_dir))


def report_top_stores(spark, sf_dir):
    report = marts.report_top_stores(_stage(spark, sf_dir), _stage_stores(spark, sf_dir), AS_OF)
    return report.withColumn("range_top_id", F.col("range_top_id").cast("bigint"))


def lifecycle_raw_stats(spark, sf_dir):
    return marts.raw_batch_stats(fixtures.raw_sales(spark, sf_dir))


def lifecycle_valid_stats(spark, sf_dir):
    return marts.valid_batch_stats(_stage(spark, sf_dir))


def lifecycle_full_outer(spark, sf_dir):
    return marts.join_batch_stats(lifecycle_raw_stats(spark, sf_dir), lifecycle_valid_stats(spark, sf_dir))


def report_transactions_lifecycle(spark, sf_dir):
    raw = fixtures.raw_sales(spark, sf_dir)
    return marts.report_transactions_lifecycle(raw, stage_sales(raw), AS_OF)


# Incremental runs


def high_water(spark, sf_dir):
    return high_water_mark(_stage(spark, sf_dir))


def stg_sales_incremental(spark, sf_dir):
    raw = fixtures.raw_sales(spark, sf_dir)
    target = stage_sales(_until(raw, SPLIT))
    return stage_sales(high_water_filter(raw, high_water_mark(target)))


def _stage_table(raw, root, watched=()):
    """A stage that all the raw rows go into; they are counted once to size its buckets."""
    buckets = buckets_for(raw.count())
    return KeyedTable(raw.sparkSession, f"{root}/stage", STAGE_SALES, SALES_KEYS, "loaded_at", "transaction_time", buckets, watched=watched)


def upsert_merge(spark, sf_dir):
    """New rows into a bucketed table, which is not shuffled for that."""
    raw = fixtures.raw_sales(spark, sf_dir)
    table = _stage_table(raw, scratch_dir(spark, "merge"))
    table.replace(stage_sales(_until(raw, SPLIT)))
    return upsert(table.read(), stage_sales(high_water_filter(raw, SPLIT)), SALES_KEYS)


def full_refresh_equivalence(spark, sf_dir):
    """A first run and two runs by high-water mark into a bucketed table; the result is that of one full run."""
    raw = fixtures.raw_sales(spark, sf_dir)
    table = _stage_table(raw, scratch_dir(spark, "runs"))
    for moment in (dt.datetime(2000, 6, 15), SPLIT, dt.datetime(9999, 1, 1)):
        table.upsert(stage_sales(high_water_filter(_until(raw, moment), table.high_water())))
    return table.read()


def _drops_out_of_order(raw):
    """The middle loads, the newest, the oldest, and the middle ones once more."""
    first, last = _until(raw, dt.datetime(2000, 6, 15)), high_water_filter(raw, SPLIT)
    between = high_water_filter(_until(raw, SPLIT), dt.datetime(2000, 6, 15))
    return between, last, first, between


def lifecycle_rollup(spark, sf_dir):
    """Loads out of order into the stage; the report comes from signed counts and reads no table again."""
    root = scratch_dir(spark, "rollup")
    raw = fixtures.raw_sales(spark, sf_dir)
    table = _stage_table(raw, root, ("batch_date", "loaded_at"))
    counts = SignedCounts(spark, f"{root}/counts")
    loads = KeyedTable(spark, f"{root}/loads", RAW_LOADS, ["batch_date", "loaded_at"], "loaded_at", "batch_date", null_safe_keys=True)
    for drop in _drops_out_of_order(raw):
        table.upsert(stage_sales(drop), counts.add)
        loads.upsert(raw_load_counts(drop))
    return marts.lifecycle_of_counts(raw_stats(loads.read()), valid_stats(counts.read()), AS_OF, limit=None)


def daily_lookback(spark, sf_dir):
    return _daily_after(spark, sf_dir, BUILT_TO)


def _daily_after(spark, sf_dir, moment):
    raw = fixtures.raw_sales(spark, sf_dir)
    target = marts.report_daily_sales(stage_sales(_until(raw, moment)), AS_OF, limit=None)
    start = lookback_start(target, "transaction_date", marts.DAILY_LOOKBACK_DAYS)
    return marts.report_daily_sales(stage_sales(raw), AS_OF, start)


def daily_lookback_seeded(spark, sf_dir):
    """The running total goes on from the report that was built before; no day before the lookback is read."""
    raw = fixtures.raw_sales(spark, sf_dir)
    target = marts.report_daily_sales(stage_sales(_until(raw, BUILT_TO)), AS_OF, limit=None)
    start = lookback_start(target, "transaction_date", marts.DAILY_LOOKBACK_DAYS)
    return marts.report_daily_sales(stage_sales(raw), AS_OF, start, seed=target)


def daily_gap_over_40_days(spark, sf_dir):
    """More new days than a full report holds: none is left out."""
    return _daily_after(spark, sf_dir, GAP_FROM)


def lifecycle_gap_over_40_days(spark, sf_dir):
    return _lifecycle_after(spark, sf_dir, GAP_FROM)


def lifecycle_lookback(spark, sf_dir):
    return _lifecycle_after(spark, sf_dir, BUILT_TO)


def _lifecycle_after(spark, sf_dir, moment):
    raw = fixtures.raw_sales(spark, sf_dir)
    built = _until(raw, moment)
    target = marts.report_transactions_lifecycle(built, stage_sales(built), AS_OF, limit=None)
    start = lookback_start(target, "batch_date", marts.LIFECYCLE_LOOKBACK_DAYS)
    return marts.report_transactions_lifecycle(raw, stage_sales(raw), AS_OF, start)


def _streamed(spark, sf_dir, root, run, repeat=True):
    """Drops out of load order and one sent again, each taken up by a run of the same stream."""
    raw = fixtures.raw_sales(spark, sf_dir)
    for drop in _drops_out_of_order(raw)[: None if repeat else 3]:
        drop.write.mode("append").option("compression", "zstd").parquet(f"{root}/raw")
        run(raw.schema)


def stream_upsert(spark, sf_dir):
    root = scratch_dir(spark, "stream-upsert")
    table = _stage_table(fixtures.raw_sales(spark, sf_dir), root)

    def run(schema):
        start_upsert(spark, f"{root}/raw", schema, table, sales_versions, f"{root}/checkpoint").awaitTermination()

    _streamed(spark, sf_dir, root, run)
    return table.read()


def stream_daily_report(spark, sf_dir):
    """The daily report over all days, of which each run of the stream computes the months it changed anew."""
    root = scratch_dir(spark, "stream-daily")
    table = _stage_table(fixtures.raw_sales(spark, sf_dir), root, ("transaction_time",))
    report = KeyedTable(spark, f"{root}/report", REPORT_DAILY_SALES, ["transaction_date"], month_of="transaction_date")
    daily = DailyReport(table, report, AS_OF)

    def run(schema):
        start_upsert(
            spark, f"{root}/raw", schema, table, sales_versions, f"{root}/checkpoint", on_change=daily.on_change, after=daily.after
        ).awaitTermination()

    _streamed(spark, sf_dir, root, run)
    return report.read()


def stream_lifecycle_report(spark, sf_dir):
    """The lifecycle report over all batches from two streams: raw rows per load, and stage versions that come and go."""
    root = scratch_dir(spark, "stream-lifecycle")
    table = _stage_table(fixtures.raw_sales(spark, sf_dir), root, ("batch_date", "loaded_at"))
    counts = SignedCounts(spark, f"{root}/counts")
    loads = KeyedTable(spark, f"{root}/loads", RAW_LOADS, ["batch_date", "loaded_at"], "loaded_at", "batch_date", null_safe_keys=True)

    def run(schema):
        start_raw_counts(spark, f"{root}/raw", schema, loads, f"{root}/checkpoint-raw").awaitTermination()
        start_upsert(
            spark, f"{root}/raw", schema, table, sales_versions, f"{root}/checkpoint", on_change=counts.add
        ).awaitTermination()

    _streamed(spark, sf_dir, root, run, repeat=False)
    return marts.lifecycle_of_counts(raw_stats(loads.read()), valid_stats(counts.read()), AS_OF, limit=None)


# Data checks


def dq_not_null(spark, sf_dir):
    sales = raw_sales(spark, sf_dir, fixtures.FIFTH_BAD_DROPS_SQL)
    stores = raw_stores(spark, sf_dir, fixtures.FEW_BAD_STORE_LINES_SQL)
    sales_check = quality.not_null(sales, ["store_token", "transaction_id", "receipt_token", "user_role"])
    stores_check = quality.not_null(stores, ["store_token", "store_name"])
    return sales_check.withColumn("table_name", F.lit("sales")).unionByName(
        stores_check.withColumn("table_name", F.lit("stores"))
    )


def dq_unique(spark, sf_dir):
    raw = quality.unique(fixtures.raw_stores(spark, sf_dir), "store_token")
    stage = quality.unique(_stage_stores(spark, sf_dir), "store_token")
    return raw.withColumn("table_name", F.lit("raw")).unionByName(stage.withColumn("table_name", F.lit("stage")))


QUERIES: dict[str, Query] = {
    "route_files": route_files,
    "inbox_filter": inbox_filter,
    "batch_date_extract": batch_date_extract,
    "csv_scan": csv_scan,
    "null_tokens": null_token_values,
    "sales_positional_shift": sales_positional_shift,
    "bad_row_policy": bad_row_policy,
    "raw_sales": raw_sales,
    "raw_stores": raw_stores,
    "history_partitions": history_partitions,
    "ingest_log": ingest_log_query,
    "csv_batch_ingest": csv_batch_ingest,
    "file_lineage": file_lineage,
    "raw_ddl": raw_ddl,
    "header_filter": header_filter,
    "amount_clean": amount_clean,
    "timestamp_parse": timestamp_parse,
    "dedup_latest_sales": dedup_latest_sales,
    "dedup_latest_stores": dedup_latest_stores,
    "stg_sales": _stage,
    "stg_stores": _stage_stores,
    "daily_store_sales": _store_days,
    "daily_stats": daily_stats,
    "top_store_per_day": top_store_per_day,
    "monthly_running_total": monthly_running_total,
    "report_daily_sales": report_daily_sales,
    "sales_left_join_stores": sales_left_join_stores,
    "top_n_dense_rank": top_n_dense_rank,
    "last_10_dates": last_10_dates,
    "report_top_stores": report_top_stores,
    "lifecycle_raw_stats": lifecycle_raw_stats,
    "lifecycle_valid_stats": lifecycle_valid_stats,
    "lifecycle_full_outer": lifecycle_full_outer,
    "report_transactions_lifecycle": report_transactions_lifecycle,
    "high_water_mark": high_water,
    "upsert_merge": upsert_merge,
    "stg_sales_incremental": stg_sales_incremental,
    "daily_lookback": daily_lookback,
    "daily_lookback_seeded": daily_lookback_seeded,
    "lifecycle_lookback": lifecycle_lookback,
    "daily_gap_over_40_days": daily_gap_over_40_days,
    "lifecycle_gap_over_40_days": lifecycle_gap_over_40_days,
    "full_refresh_equivalence": full_refresh_equivalence,
    "lifecycle_rollup": lifecycle_rollup,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "csv_stream_ingest": csv_stream_ingest,
    "stream_upsert": stream_upsert,
    "stream_daily_report": stream_daily_report,
    "stream_lifecycle_report": stream_lifecycle_report,
}


def queries() -> dict[str, Query]:
    return {name: (lambda spark, sf_dir, q=query: _plain(q(spark, sf_dir))) for name, query in QUERIES.items()}
