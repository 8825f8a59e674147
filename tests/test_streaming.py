import datetime as dt
import glob
import os

import pytest
from pyspark.errors import StreamingQueryException

from helpers import at, raw_sales, tuples
from tallyhouse.operators.rollup import SignedCounts, valid_stats
from tallyhouse.plans.stage import sales_versions
from tallyhouse.schemas import RAW_SALES, REPORT_DAILY_SALES, SALES_KEYS, STAGE_SALES
from tallyhouse.sources.keyed import KeyedTable
from tallyhouse.sources.raw import read_raw
from tallyhouse.streaming.ingest import start_ingest
from tallyhouse.streaming.stage import DailyReport, start_upsert

TODAY = dt.date(2025, 1, 31)


def put(folder, name, *rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(r + "\n" for r in rows))


def forget_last_commit(checkpoint):
    """Leave the checkpoint as it is when a batch dies after its work and before its commit."""
    commits = [f for f in os.listdir(f"{checkpoint}/commits") if f.isdigit()]
    last = max(commits, key=int)
    for name in (last, f".{last}.crc"):
        os.remove(f"{checkpoint}/commits/{name}")


def test_ingest_replays_a_dead_batch_without_duplicates(spark, tmp_path):
    inbox, root, checkpoint = tmp_path / "inbox", str(tmp_path / "wh"), str(tmp_path / "cp")

    def run():
        start_ingest(spark, str(inbox), root, checkpoint, TODAY, archive=True).awaitTermination()
        return read_raw(spark, f"{root}/raw/sales", RAW_SALES)

    put(inbox, "sales_20250111.csv", "A,x1,r1,t,1,clerk", "A,x2,r1,t,1,src,clerk")
    assert run().count() == 2
    put(inbox, "sales_20250112.csv", "A,x3,r1,t,1,clerk")
    put(inbox, "sales_20250113.csv", 'A,x4,"r1,t,1,clerk')
    before = {r.transaction_id: r.loaded_at for r in run().collect()}
    forget_last_commit(checkpoint)
    after = {r.transaction_id: r.loaded_at for r in run().collect()}
    assert before == after and set(after) == {"x1", "x2", "x3"}
    assert run().count() == 3
    log = spark.read.parquet(f"{root}/ingest_log")
    assert sorted(r[0] for r in tuples(log, "status")) == ["loaded", "loaded", "rejected"]
    assert spark.read.parquet(f"{root}/history").count() == 3


def test_ingest_in_several_batches_and_nested_folders(spark, tmp_path):
    inbox, root = tmp_path / "inbox", str(tmp_path / "wh")
    for day in (1, 2, 3):
        put(inbox / f"d{day}", f"sales_2025010{day}.csv", f"A,x{day},r1,t,1,clerk")
    start_ingest(spark, str(inbox), root, str(tmp_path / "cp"), TODAY, max_files=1).awaitTermination()
    sales = read_raw(spark, f"{root}/raw/sales", RAW_SALES)
    assert sorted(tuples(sales, "transaction_id", "batch_date")) == [
        (f"x{day}", dt.date(2025, 1, day)) for day in (1, 2, 3)
    ]
    assert sales.select("ingest_batch").distinct().count() == 3


def test_a_file_that_cannot_be_read_does_not_stop_the_stream(spark, tmp_path):
    """A broken archive among good files, one with a blank in its name: it is in the log, they land, and later batches go on."""
    inbox, root, checkpoint = tmp_path / "inbox", str(tmp_path / "wh"), str(tmp_path / "cp")

    def run():
        start_ingest(spark, str(inbox), root, checkpoint, TODAY).awaitTermination()
        return sorted(r[0] for r in tuples(read_raw(spark, f"{root}/raw/sales", RAW_SALES), "transaction_id"))

    put(inbox, "sales_20250111.csv", "A,x1,r1,t,1,clerk")
    put(inbox, "sales 20250112.csv", "A,x2,r1,t,1,clerk")
    (inbox / "sales_20250113.csv.gz").write_bytes(b"no archive")
    assert run() == ["x1", "x2"]
    log = spark.read.parquet(f"{root}/ingest_log")
    found = {r.file_path.rpartition("/")[2]: (r.status, r.error) for r in log.collect()}
    assert found == {
        "sales_20250111.csv": ("loaded", None),
        "sales 20250112.csv": ("loaded", None),
        "sales_20250113.csv.gz": ("rejected", "unreadable"),
    }
    put(inbox, "sales_20250114.csv", "A,x4,r1,t,1,clerk")
    assert run() == ["x1", "x2", "x4"]
    forget_last_commit(checkpoint)
    assert run() == ["x1", "x2", "x4"]


def sales_table(spark, path, *watched):
    return KeyedTable(spark, path, STAGE_SALES, SALES_KEYS, "loaded_at", "transaction_time", 2, watched=watched)


def test_upsert_stream_keeps_latest_and_survives_replay(spark, tmp_path):
    raw, checkpoint = str(tmp_path / "raw"), str(tmp_path / "cp")
    table, counts, seen = sales_table(spark, str(tmp_path / "stage"), "batch_date", "loaded_at"), SignedCounts(spark, str(tmp_path / "n")), []

    def run():
        start_upsert(
            spark, raw, RAW_SALES, table, sales_versions, checkpoint, on_change=counts.add, after=lambda: seen.append(table.high_water())
        ).awaitTermination()
        return sorted(tuples(table.read(), "transaction_id", "receipt_token"), key=str)

    def put_raw(*rows):
        raw_sales(spark, list(rows)).write.mode("append").parquet(raw)

    put_raw({"transaction_id": "1", "receipt_token": "old"}, {"transaction_id": "2", "receipt_token": "old"}, {"transaction_id": None})
    assert run() == [("1", "old"), ("2", "old"), (None, "r1")]
    later = {"loaded_at": at("2021-02-01 00:00:00"), "receipt_token": "new"}
    put_raw({"transaction_id": "2", **later}, {"transaction_id": "3", **later}, {"transaction_id": None, **later})
    expected = [("1", "old"), ("2", "new"), ("3", "new"), (None, "new")]
    assert run() == expected
    forget_last_commit(checkpoint)
    assert run() == expected
    # Late rows of an earlier load, one of a new key; a tie in the load time is settled by the file time.
    early = {"loaded_at": at("2021-01-04 00:00:00"), "receipt_token": "late"}
    put_raw({"transaction_id": "3", **early}, {"transaction_id": "4", **early})
    put_raw({"transaction_id": "1", "receipt_token": "a", "file_modified_at": at("2021-01-06 00:00:00")})
    assert run() == [("1", "a"), ("2", "new"), ("3", "new"), ("4", "late"), (None, "new")]
    assert sum(r[0] for r in tuples(valid_stats(counts.read()), "total_valid_rows")) == 5
    assert seen[-1] == at("2021-02-01 00:00:00")
    metadata = [name for name in os.listdir(f"{checkpoint}/state/0/0") if name.endswith(".zip") or name.endswith(".changelog")]
    assert metadata  # the files of the store on disk


def test_upsert_stream_keeps_one_copy_of_its_rows_on_disk(spark, tmp_path, monkeypatch):
    """When a batch's rows are in their places, no copy of them lies aside, in a shuffle or, of the state, on an executor's disk."""
    raw, checkpoint = str(tmp_path / "raw"), str(tmp_path / "cp")
    table = KeyedTable(spark, str(tmp_path / "stage"), STAGE_SALES, SALES_KEYS, "loaded_at", "transaction_time", 3)
    (blocks,) = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()

    def files(folder, pattern):
        return {path for path in glob.glob(f"{folder}/{pattern}", recursive=True) if os.path.isfile(path)}

    left = []

    def note(self, months):
        rows = files(f"{table.path}.pending", "*/**/part-*.parquet")
        left.append([path for path in rows if not {"months", "filled"} & set(path.split("/"))])
        left.append([path for path in files(blocks, "*/shuffle_*.data") - before if os.path.getsize(path) > 20_000])

    monkeypatch.setattr(KeyedTable, "_drop_months", note)
    for start in (0, 3000, 0):
        before = files(blocks, "*/shuffle_*.data")
        rows = [{"transaction_id": str(k), "receipt_token": f"{k * 7919 % 100_003}"} for k in range(start, start + 6000)]
        raw_sales(spark, rows).coalesce(1).write.mode("append").parquet(raw)
        start_upsert(spark, raw, RAW_SALES, table, sales_versions, checkpoint).awaitTermination()
    assert table.read().count() == 9000
    assert len(left) == 6 and not any(left)
    state = [int(name) for name in os.listdir(f"{checkpoint}/state/0") if name.isdigit()]
    assert sorted(state) == list(range(6))  # the next multiple of the buckets above the session's 4


def test_daily_report_follows_late_and_moved_days(spark, tmp_path):
    """A late day months back, a day whose only row moves away, and a run that dies between the stage and the report."""
    raw, checkpoint = str(tmp_path / "raw"), str(tmp_path / "cp")
    table = sales_table(spark, str(tmp_path / "stage"), "transaction_time")
    report = KeyedTable(spark, str(tmp_path / "report"), REPORT_DAILY_SALES, ["transaction_date"], month_of="transaction_date")
    daily = DailyReport(table, report, TODAY)

    def run(after=daily.after):
        start_upsert(spark, raw, RAW_SALES, table, sales_versions, checkpoint, on_change=daily.on_change, after=after).awaitTermination()
        return {r[0].isoformat(): int(r[1]) for r in tuples(report.read(), "transaction_date", "monthly_cumulative_sales")}

    def put_raw(hour, *rows):
        rows = [{"transaction_id": k, "transaction_time": f"{day}T100000.000", "amount": a, "loaded_at": at(f"2021-06-01 {hour}:00:00")} for k, day, a in rows]
        raw_sales(spark, rows).write.mode("append").parquet(raw)

    put_raw(10, ("1", "20210505", "1"), ("2", "20210507", "2"), ("3", "20210320", "4"))
    assert run() == {"2021-05-05": 1, "2021-05-07": 3, "2021-03-20": 4}
    put_raw(11, ("4", "20210301", "8"), ("2", "20210409", "2"))
    assert run() == {"2021-05-05": 1, "2021-04-09": 2, "2021-03-01": 8, "2021-03-20": 12}

    def die():
        raise RuntimeError("stopped")

    put_raw(12, ("3", "20210506", "4"))
    with pytest.raises(StreamingQueryException):
        run(die)
    assert run() == {"2021-05-05": 1, "2021-05-06": 5, "2021-04-09": 2, "2021-03-01": 8}
    with pytest.raises(ValueError):
        DailyReport(sales_table(spark, str(tmp_path / "other")), report)
