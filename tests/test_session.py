import datetime as dt

import pytest

from helpers import at, raw_sales, tuples
from tallyhouse.schemas import RAW_SALES
from tallyhouse.session import child_names, scratch_dir, sizing
from tallyhouse.sources.raw import append_raw, read_raw

TIB = 1 << 40


def test_sizing_follows_the_data_up_to_a_bound():
    small, large = sizing(1 << 30, 8), sizing(100 * TIB, 8000)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 << 20)
    assert large["spark.sql.shuffle.partitions"] == "50000"
    tasks = 100 * TIB / int(large["spark.sql.files.maxPartitionBytes"])
    assert tasks <= 200_001


def test_scratch_lies_in_the_shared_folder(spark, monkeypatch, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    folder = scratch_dir(spark, "x")
    assert folder != scratch_dir(spark, "x")
    if shared:
        assert folder.startswith(shared.rstrip("/") + "/x-")


def test_a_cluster_has_to_name_a_shared_folder():
    class Settings:
        def __init__(self, **values):
            self.conf = {k.replace("_", "."): v for k, v in values.items()}

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", ""):
        with pytest.raises(ValueError):
            scratch_dir(Settings(spark_master=master), "x")
    assert "/x-" in scratch_dir(Settings(spark_master="local[4]"), "x")


def test_raw_folders_of_old_loads_are_not_listed(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert read_raw(spark, path, RAW_SALES).count() == 0
    for day in (1, 2, 3):
        loaded = at(f"2021-01-0{day} 10:00:00")
        append_raw(raw_sales(spark, [{"transaction_id": str(day), "loaded_at": loaded}]), path, f"b{day}")
    assert child_names(spark, path, "load_date=*") == [f"load_date=2021-01-0{d}" for d in (1, 2, 3)]
    recent = read_raw(spark, path, RAW_SALES, dt.date(2021, 1, 2))
    assert sorted(tuples(recent, "transaction_id", "ingest_batch", "load_date")) == [
        ("2", "b2", dt.date(2021, 1, 2)),
        ("3", "b3", dt.date(2021, 1, 3)),
    ]
    assert all("2021-01-01" not in name for name in recent.inputFiles())
    assert read_raw(spark, path, RAW_SALES, dt.date(2022, 1, 1)).count() == 0
    append_raw(raw_sales(spark, [{"transaction_id": "2b", "loaded_at": at("2021-01-02 10:00:00")}]), path, "b2")
    assert sorted(tuples(read_raw(spark, path, RAW_SALES), "transaction_id")) == [("1",), ("2b",), ("3",)]
