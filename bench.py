"""Times the headline runs and prints one JSON line.

Raw and stage tables are written first and not timed, as each run reads the layer below it.
Settings: BENCH_SF_DIR, BENCH_CPUS, BENCH_REPEATS.
"""

from __future__ import annotations

import datetime as dt
import itertools
import json
import os
import statistics
import time

from pyspark.sql import functions as F

from tallyhouse.checks import fixtures
from tallyhouse.checks.fixtures import AS_OF
from tallyhouse.functions.clock import clock_literal
from tallyhouse.functions.files import TRANSACTIONS
from tallyhouse.operators.incremental import high_water_filter
from tallyhouse.operators.landing import good_lines, ingest_log, sales_rows
from tallyhouse.operators.rollup import WATCHED, SignedCounts, raw_load_counts, raw_stats, valid_stats
from tallyhouse.plans import marts
from tallyhouse.plans.landing import land_files
from tallyhouse.plans.stage import stage_sales, stage_stores
from tallyhouse.schemas import RAW_LOADS, REPORT_DAILY_SALES, SALES_KEYS, STAGE_SALES, STAGE_STORES, STORES_KEYS
from tallyhouse.session import build_session, scratch_dir
from tallyhouse.sources.keyed import KeyedTable
from tallyhouse.sources.lines import read_lines

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
#: Parts by key of the stage: a month of the bench has some 6,000 rows.
BUCKETS = 2
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def prepare(spark, root: str) -> dict:
    """Write the raw layer, the CSV drops and the stage layer."""
    raw = fixtures.raw_sales(spark, SF_DIR)
    raw.repartition(int(CPUS)).write.parquet(f"{root}/raw_sales")
    fixtures.raw_stores(spark, SF_DIR).write.parquet(f"{root}/raw_stores")
    lines = fixtures.sales_lines(spark, SF_DIR).filter(~F.col("bad"))
    fixtures.write_drop(lines.repartition(int(CPUS)), f"{root}/inbox", "sales_20250111")
    raw = spark.read.parquet(f"{root}/raw_sales")
    stores = spark.read.parquet(f"{root}/raw_stores")
    newest = raw.agg(F.max("loaded_at")).first()[0]
    cut = raw.select(F.expr("percentile(unix_micros(cast(loaded_at as timestamp)), 0.99)")).first()[0]
    cut = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=int(cut))
    older = raw.filter(F.col("loaded_at") <= clock_literal(cut))

    def table(name):
        return KeyedTable(spark, f"{root}/{name}", STAGE_SALES, SALES_KEYS, "loaded_at", "transaction_time", BUCKETS, watched=WATCHED)

    whole, split, grown = table("stage_sales"), table("split_sales"), table("grown_sales")
    whole.replace(stage_sales(raw))
    split.replace(stage_sales(older))
    grown.replace(stage_sales(older))
    counts = SignedCounts(spark, f"{root}/counts")
    counts.count_whole(grown.read())
    grown.upsert(stage_sales(high_water_filter(raw, cut)), counts.add)
    loads = KeyedTable(spark, f"{root}/loads", RAW_LOADS, ["batch_date", "loaded_at"], "loaded_at", "batch_date", null_safe_keys=True)
    loads.replace(raw_load_counts(raw))
    stage_of_stores = KeyedTable(spark, f"{root}/stage_stores", STAGE_STORES, STORES_KEYS, "loaded_at")
    stage_of_stores.replace(stage_stores(stores))
    return {
        "raw": raw,
        "raw_stores": stores,
        "cut": cut,
        "start": newest.date() - dt.timedelta(days=marts.DAILY_LOOKBACK_DAYS),
        "whole": whole,
        "split": split,
        "grown": grown,
        "stores": stage_of_stores,
        "counts": counts,
        "loads": loads,
        "root": root,
    }


def jobs(spark, env: dict) -> dict:
    raw, start = env["raw"], env["start"]

    laps = itertools.count(1)

    def newer_delta():
        """The newest hundredth of the rows, loaded later each time, as a run by high-water mark has it."""
        rows = stage_sales(high_water_filter(raw, env["cut"]))
        later = F.col("loaded_at") + F.make_dt_interval(days=F.lit(10_000 * next(laps)))
        env["split"].upsert(rows.withColumn("loaded_at", later))

    def land_parse():
        lines = read_lines(spark, f"{env['root']}/inbox", env["cut"])
        run(sales_rows(good_lines(lines, ingest_log(lines, AS_OF), TRANSACTIONS, max_files=1000)))

    return {
        "landing_parse": land_parse,
        "stg_sales_full": lambda: run(stage_sales(raw)),
        "stg_stores_full": lambda: run(stage_stores(env["raw_stores"])),
        "stg_sales_delta_1pct": newer_delta,
        "stg_sales_read_with_delta": lambda: run(env["grown"].read()),
        "report_daily_sales_full": lambda: run(marts.report_daily_sales(env["whole"].read(), AS_OF)),
        "report_daily_sales_lookback": lambda: run(
            marts.report_daily_sales(env["grown"].read(start.replace(day=1)), AS_OF, start)
        ),
        "report_top_stores_full": lambda: run(
            marts.report_top_stores(env["whole"].read(), env["stores"].read(), AS_OF)
        ),
        "report_transactions_lifecycle_full": lambda: run(
            marts.report_transactions_lifecycle(raw, env["whole"].read(), AS_OF)
        ),
        # As a run has it: from the counts that stage runs keep.
        "report_transactions_lifecycle_lookback": lambda: run(
            marts.lifecycle_of_counts(raw_stats(env["loads"].read()), valid_stats(env["counts"].read()), AS_OF, start)
        ),
    }


def writes(spark, env: dict) -> dict:
    """Runs that write tables; not part of the headline total, which stays comparable."""
    root = env["root"]
    refreshed = KeyedTable(spark, f"{root}/refreshed", STAGE_SALES, SALES_KEYS, "loaded_at", "transaction_time", BUCKETS)
    report = KeyedTable(spark, f"{root}/report", REPORT_DAILY_SALES, ["transaction_date"], month_of="transaction_date")
    report.replace(marts.report_daily_sales(env["whole"].read(), AS_OF, limit=None))

    def merge_report():
        rows = marts.report_daily_sales(env["grown"].read(env["start"].replace(day=1)), AS_OF, env["start"])
        report.upsert(rows)

    return {
        "land_files": lambda: land_files(spark, f"{root}/inbox", scratch_dir(spark, "bench-landing"), AS_OF),
        "full_refresh_to_table": lambda: refreshed.replace(stage_sales(env["raw"])),
        "merge_report": merge_report,
    }


def timed(jobs: dict) -> dict:
    timings = {}
    for name, job in jobs.items():
        job()
        laps = []
        for _ in range(REPEATS):
            begin = time.perf_counter()
            job()
            laps.append(time.perf_counter() - begin)
        timings[name] = round(statistics.median(laps), 4)
    return timings


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "8g", "spark.log.level": "ERROR"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    env = prepare(spark, scratch_dir(spark, "bench"))
    timings = timed(jobs(spark, env))
    total = round(sum(timings.values()), 4)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": total,
                "unit": "sec",
                "queries": timings,
                "writes": timed(writes(spark, env)),
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
