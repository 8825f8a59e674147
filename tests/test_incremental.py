import datetime as dt
import itertools
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import at, raw_sales, staged, tuples
from tallyhouse.operators.dedup import keep_latest, newest_by_aggregate
from tallyhouse.operators.incremental import high_water_filter, high_water_mark, lookback_start, since, upsert
from tallyhouse.operators.rollup import SignedCounts, raw_load_counts, raw_stats, valid_stats
from tallyhouse.plans import marts
from tallyhouse.plans.stage import stage_sales
from tallyhouse.schemas import RAW_LOADS, SALES_KEYS, STAGE_SALES, STAGE_STORES, STORES_KEYS
from tallyhouse.sources import keyed
from tallyhouse.sources.keyed import KeyedTable

HOUR = dt.timedelta(hours=1)


def test_high_water_filter(spark):
    raw = raw_sales(spark, [{"transaction_id": str(i), "loaded_at": at("2021-01-01") + i * HOUR} for i in range(4)])
    target = stage_sales(raw.filter("transaction_id < '2'"))
    for mark in (high_water_mark(target), at("2021-01-01 01:00:00")):
        newer = high_water_filter(raw, mark)
        assert sorted(tuples(newer, "transaction_id")) == [("2",), ("3",)]
    assert high_water_filter(raw, None).count() == 4
    empty = high_water_mark(target.limit(0))
    assert high_water_filter(raw, empty).count() == 4


def test_high_water_prunes_day_folders(spark):
    raw = raw_sales(spark, [{"loaded_at": at("2021-01-01") + i * 12 * HOUR} for i in range(4)])
    dated = raw.selectExpr("*", "to_date(loaded_at) as load_date")
    newer = high_water_filter(dated, at("2021-01-01 00:00:00"), day_partition="load_date")
    assert newer.count() == 3


def test_lookback_counts_whole_days(spark):
    target = spark.createDataFrame([(dt.date(2021, 1, 10),), (dt.date(2021, 1, 3),)], "transaction_date date")
    start = lookback_start(target, "transaction_date", 7)
    assert start.first().start == dt.date(2021, 1, 3)
    sales = staged(spark, [("a", d, f"2021-01-{d}T00:00", 1) for d in ("01", "02", "03", "04")])
    kept = since(sales, "transaction_time", start)
    assert sorted(tuples(kept, "transaction_id")) == [("03",), ("04",)]
    everything = lookback_start(target.limit(0), "transaction_date", 7)
    assert since(sales, "transaction_time", everything).count() == 4


def test_upsert_null_keys(spark):
    target = spark.createDataFrame([("a", 1, "old"), ("a", None, "old"), ("b", 2, "old")], "k string, n int, v string")
    delta = spark.createDataFrame([("a", 1, "new"), ("a", None, "new"), ("c", 3, "new")], "k string, n int, v string")
    plain = sorted(tuples(upsert(target, delta, ["k", "n"])), key=str)
    assert plain == sorted(
        [("a", 1, "new"), ("a", None, "old"), ("a", None, "new"), ("b", 2, "old"), ("c", 3, "new")], key=str
    )
    safe = sorted(tuples(upsert(target, delta, ["k", "n"], null_safe_keys=True)), key=str)
    assert safe == sorted([("a", 1, "new"), ("a", None, "new"), ("b", 2, "old"), ("c", 3, "new")], key=str)


counter = itertools.count()
row = st.tuples(
    st.sampled_from(["a", "b"]),
    st.sampled_from(["1", "2", "3"]),
    st.sampled_from(["5.00", "6.00", "bad"]),
    st.sampled_from(["20210105T100000.000", "20210205T100000.000", "never"]),
    st.integers(0, 6),
)


@settings(
    max_examples=6,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    rows=st.lists(row, min_size=1, max_size=25),
    cuts=st.sets(st.integers(0, 6), max_size=3),
    forget=st.booleans(),
)
def test_incremental_equals_full_refresh(spark, tmp_path, rows, cuts, forget):
    raw = raw_sales(
        spark,
        [
            {
                "store_token": s,
                "transaction_id": t,
                "amount": a,
                "transaction_time": w,
                "loaded_at": at("2021-01-01") + h * HOUR,
            }
            for s, t, a, w, h in rows
        ],
    )
    table = sales_table(spark, f"{tmp_path}/t{next(counter)}")
    for cut in sorted(cuts | {6}):
        landed = raw.filter(raw.loaded_at <= at("2021-01-01") + cut * HOUR)
        table.upsert(stage_sales(high_water_filter(landed, table.high_water())))
        if forget:  # another session does not know the table yet
            spark.sql(f"DROP TABLE {table.name}")
    full = stage_sales(raw)
    assert sorted(tuples(table.read()), key=str) == sorted(tuples(full), key=str)
    start = dt.date(2021, 2, 5)
    recent = full.filter("transaction_time >= date'2021-02-05'")
    assert sorted(tuples(table.read(start)), key=str) == sorted(tuples(recent), key=str)


def sales_table(spark, path, **options):
    return KeyedTable(spark, path, STAGE_SALES, SALES_KEYS, "loaded_at", "transaction_time", 2, **options)


def later(rows, hours=1):
    return rows.withColumn("loaded_at", F.col("loaded_at") + F.expr(f"INTERVAL {hours} HOURS"))


def amounts(table):
    return {r[0]: int(r[1]) for r in tuples(table.read(), "transaction_id", "amount")}


def test_null_keys_add_one_row_per_run(spark, tmp_path):
    table, safe = sales_table(spark, f"{tmp_path}/t"), sales_table(spark, f"{tmp_path}/s", null_safe_keys=True)
    for amount in (1, 2, 3):
        for t in (table, safe):
            t.upsert(later(staged(spark, [("a", None, None, amount), ("a", "k", None, amount)]), amount))
    assert sorted(str(r[0]) for r in tuples(table.read().filter("transaction_id is null"), "amount")) == ["1.00", "2.00", "3.00"]
    assert sorted(map(str, amounts(safe).items())) == ["('k', 3)", "(None, 3)"]


def test_empty_table_and_empty_run(spark, tmp_path):
    table = sales_table(spark, f"{tmp_path}/t")
    assert table.read().count() == 0 and table.high_water() is None
    nothing = staged(spark, [])
    table.upsert(nothing)
    assert table.read().count() == 0 and table.high_water() is None
    table.upsert(staged(spark, [("a", "1", "2021-01-01T10:00", 1)]))
    table.upsert(nothing)
    assert amounts(table) == {"1": 1} and table.high_water() == at("2021-01-05 13:00:00")


def test_a_correction_that_moves_a_row_empties_its_month(spark, tmp_path):
    table = sales_table(spark, f"{tmp_path}/t")
    table.upsert(staged(spark, [("a", "1", "2021-03-05T10:00", 1), ("a", "2", "2021-04-06T10:00", 1), ("a", "3", None, 1)]))
    table.upsert(later(staged(spark, [("a", "1", "2021-01-05T10:00", 2), ("a", "3", "2021-01-07T10:00", 2)])))
    months = sorted(name for name in os.listdir(f"{tmp_path}/t") if "=" in name)
    assert months == ["transaction_time_month=2021-01-01", "transaction_time_month=2021-04-01"]
    assert amounts(table) == {"1": 2, "2": 1, "3": 2}
    assert tuples(table.read(dt.date(2021, 3, 1)), "transaction_id") == [("2",)]


def test_months_without_a_change_keep_their_files(spark, tmp_path):
    table = sales_table(spark, f"{tmp_path}/t")
    table.upsert(staged(spark, [("a", str(k), f"2021-0{k}-05T10:00", 1) for k in range(1, 6)]))

    def files():
        return {name: sorted(os.listdir(f"{tmp_path}/t/{name}")) for name in os.listdir(f"{tmp_path}/t") if "=" in name}

    before = files()
    table.upsert(later(staged(spark, [("a", "2", "2021-02-06T10:00", 2), ("a", "9", "2021-04-07T10:00", 2)])))
    after = files()
    changed = {name for name in before if before[name] != after[name]}
    assert changed == {"transaction_time_month=2021-02-01", "transaction_time_month=2021-04-01"}
    assert amounts(table) == {"1": 1, "2": 2, "3": 1, "4": 1, "5": 1, "9": 2}


def test_what_another_session_writes_is_seen(spark, tmp_path):
    """Another name for the same folder stands for another session's catalog: months that come, change and go are seen."""
    here, there = sales_table(spark, f"{tmp_path}/t"), sales_table(spark, f"{tmp_path}/./t")
    here.upsert(staged(spark, [("a", "1", "2021-03-05T10:00", 1), ("a", "2", "2021-04-06T10:00", 1)]))
    assert amounts(there) == {"1": 1, "2": 1}
    there.upsert(later(staged(spark, [("a", "3", "2021-05-05T10:00", 3), ("a", "1", "2021-03-06T10:00", 2)])))
    assert amounts(here) == {"1": 2, "2": 1, "3": 3}
    here.upsert(later(staged(spark, [("a", "2", "2021-03-07T10:00", 4)]), 2))
    assert amounts(there) == {"1": 2, "2": 4, "3": 3}
    assert there.high_water() == at("2021-01-05 15:00:00")


def test_the_newest_load_wins_in_whatever_order_runs_come(spark, tmp_path):
    table = sales_table(spark, f"{tmp_path}/t")
    drops = [later(staged(spark, [("a", k, "2021-03-05T10:00", h) for k in keys]), h) for h, keys in ((2, "12"), (1, "123"), (4, "3"), (3, "34"))]
    for drop in [*drops, drops[1]]:
        table.upsert(drop)
    assert amounts(table) == {"1": 2, "2": 2, "3": 4, "4": 3}
    assert table.high_water() == at("2021-01-05 17:00:00")


class Stopped(Exception):
    pass


@pytest.mark.parametrize("step", ["_insert", "_drop_months", "_note_mark"])
def test_a_run_that_dies_is_finished_by_the_next(spark, tmp_path, monkeypatch, step):
    """Whatever step it dies at once its rows are written aside, nothing is lost and the counts are added once."""
    table = sales_table(spark, f"{tmp_path}/t", watched=("batch_date", "loaded_at"))
    counts = SignedCounts(spark, f"{tmp_path}/counts")
    table.upsert(staged(spark, [("a", "1", "2021-03-05T10:00", 1, "2021-01-01"), ("a", "2", "2021-04-06T10:00", 1, "2021-01-01")]), counts.add)

    def stop(*_):
        raise Stopped

    with monkeypatch.context() as patched:
        patched.setattr(KeyedTable, step, stop)
        with pytest.raises(Stopped):
            table.upsert(later(staged(spark, [("a", "1", "2021-02-05T10:00", 2, "2021-01-02")])), counts.add)
    assert table.high_water() == at("2021-01-05 13:00:00")
    table.recover(counts.add)
    assert amounts(table) == {"1": 2, "2": 1} and table.high_water() == at("2021-01-05 14:00:00")
    table.upsert(later(staged(spark, [("a", "3", "2021-02-05T10:00", 3, "2021-01-02")]), 2), counts.add)
    assert amounts(table) == {"1": 2, "2": 1, "3": 3}
    found = sorted(tuples(valid_stats(counts.read()), "batch_date", "total_valid_rows"))
    assert found == [(dt.date(2021, 1, 1), 1), (dt.date(2021, 1, 2), 2)]


@pytest.mark.parametrize("step", ["_place", "move_path", "_drop_months", "_note_mark"])
def test_a_run_that_dies_while_months_move_is_finished_by_the_next(spark, tmp_path, monkeypatch, step):
    """Nobody watches, so months are laid aside as they will lie; `move_path` dies at the second month."""
    table = sales_table(spark, f"{tmp_path}/t")
    table.upsert(staged(spark, [("a", "1", "2021-03-05T10:00", 1), ("a", "2", "2021-04-06T10:00", 1), ("a", "3", None, 1)]))
    real, moved = keyed.move_path, []

    def stop(*args):
        if step == "move_path" and not moved:
            moved.append(args)
            return real(*args)
        raise Stopped

    with monkeypatch.context() as patched:
        patched.setattr(keyed if step == "move_path" else KeyedTable, step, stop)
        with pytest.raises(Stopped):
            table.upsert(later(staged(spark, [("a", "1", "2021-02-05T10:00", 2), ("a", "2", "2021-04-07T10:00", 2)])))
    assert table.high_water() == at("2021-01-05 13:00:00")
    table.upsert(later(staged(spark, [("a", "3", "2021-02-05T10:00", 3)]), 2))
    assert amounts(table) == {"1": 2, "2": 2, "3": 3} and table.high_water() == at("2021-01-05 15:00:00")
    months = sorted(name for name in os.listdir(f"{tmp_path}/t") if "=" in name)
    assert months == ["transaction_time_month=2021-02-01", "transaction_time_month=2021-04-01"]
    assert os.listdir(f"{tmp_path}/t.pending") == [] and not [t for t in spark.catalog.listTables("default") if t.name.startswith(table.name.split(".")[1] + "_")]


def test_null_safe_merges_in_buckets_equal_those_without(spark, tmp_path):
    """Rows with a NULL in their key go another way through the join; the others do not shuffle the table."""
    times = ["2021-03-05T10:00", "2021-04-06T10:00", None]
    keys = [(store, k) for store in ("a", "b", None) for k in ("1", "2", "3", None)]
    drops = [later(staged(spark, [(*key, times[(n + h) % 3], h) for n, key in enumerate(keys) if (n * h) % 5 < 3]), h) for h in (3, 1, 2, 4, 3)]
    got = []
    for buckets in (3, 0):
        table = KeyedTable(spark, f"{tmp_path}/t{buckets}", STAGE_SALES, SALES_KEYS, "loaded_at", "transaction_time", buckets, null_safe_keys=True)
        for drop in drops:
            table.upsert(drop)
        got.append(sorted(tuples(table.read()), key=str))
    assert got[0] == got[1] and len(got[0]) == len(keys)


def test_rows_written_aside_in_part_are_forgotten(spark, tmp_path):
    table = sales_table(spark, f"{tmp_path}/t")
    table.upsert(staged(spark, [("a", "1", None, 1)]))
    staged(spark, [("a", "2", None, 1)]).write.parquet(f"{tmp_path}/t.pending/dead/sent")
    assert amounts(table) == {"1": 1}
    table.upsert(staged(spark, [("a", "3", None, 1)]))
    assert amounts(table) == {"1": 1, "3": 1} and os.listdir(f"{tmp_path}/t.pending") == []


def test_signed_counts_equal_a_full_count(spark, tmp_path):
    """Batches sent again, corrected into other batches and out of order."""
    table = sales_table(spark, f"{tmp_path}/t", watched=("batch_date", "loaded_at"))
    counts = SignedCounts(spark, f"{tmp_path}/counts")
    loads = KeyedTable(spark, f"{tmp_path}/loads", RAW_LOADS, ["batch_date", "loaded_at"], "loaded_at", "batch_date", null_safe_keys=True)
    drops = []
    for hour, day, keys in ((3, 3, "12"), (1, 1, "1234"), (2, 2, "34"), (5, 3, "56"), (2, 2, "34"), (4, 1, "6")):
        moment = at("2021-01-05") + hour * HOUR
        rows = [{"transaction_id": k, "loaded_at": moment, "batch_date": dt.date(2021, 1, day)} for k in keys]
        if hour == 5:
            rows += [{"store_token": "store_token", "loaded_at": moment, "batch_date": None}]
        drops.append(raw_sales(spark, rows))
    landed = {}
    for k, drop in enumerate(drops):
        table.upsert(stage_sales(drop), counts.add)
        loads.upsert(raw_load_counts(drop))
        landed[drop.first().loaded_at] = drop  # a load that is sent again is the same load
        raw = None
        for one in landed.values():
            raw = one if raw is None else raw.unionByName(one)
        got = marts.lifecycle_of_counts(raw_stats(loads.read()), valid_stats(counts.read()), dt.date(2021, 2, 1))
        want = marts.report_transactions_lifecycle(raw, stage_sales(raw), dt.date(2021, 2, 1))
        assert sorted(tuples(got), key=str) == sorted(tuples(want), key=str), k


def test_tables_without_months_and_replaced_months(spark, tmp_path):
    stores = KeyedTable(spark, f"{tmp_path}/s", STAGE_STORES, STORES_KEYS, "loaded_at")
    rows = [spark.createDataFrame([(k, "g", n, None, at("2021-01-01"))], STAGE_STORES) for k, n in (("a", "x"), ("b", "y"), ("a", "z"))]
    for r in rows:
        stores.upsert(r)
    assert sorted(tuples(stores.read(), "store_token", "store_name")) == [("a", "z"), ("b", "y")]
    stores.replace(rows[0])
    assert tuples(stores.read(), "store_name") == [("x",)]
    table = sales_table(spark, f"{tmp_path}/t")
    table.upsert(staged(spark, [("a", "1", "2021-03-05T10:00", 1), ("a", "2", "2021-04-06T10:00", 1), ("a", "3", None, 1)]))
    table.replace_months(table.read_months([dt.date(2021, 3, 1), None]).where("transaction_id = '1'"), [dt.date(2021, 3, 1), None])
    assert amounts(table) == {"1": 1, "2": 1}


def test_newest_by_aggregate_equals_keep_latest(spark):
    moments = [at("2021-01-01"), at("2021-01-02"), None]
    rows = [{"transaction_id": str(k % 5), "loaded_at": moments[k % 3], "amount": [None, "1.00", "2.00"][k % 7 % 3]} for k in range(60)]
    raw = raw_sales(spark, rows).dropDuplicates()
    want = sorted(tuples(keep_latest(raw, SALES_KEYS), *raw.columns), key=str)
    assert sorted(tuples(newest_by_aggregate(raw, SALES_KEYS), *raw.columns), key=str) == want
