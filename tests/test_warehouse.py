import datetime as dt
import os
from decimal import Decimal

from helpers import tuples
from tallyhouse.functions.cleaning import COMPACT, ISO_SPACE, ISO_T
from tallyhouse.plans import marts
from tallyhouse.plans.landing import land, read_null_counts
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.sources.lines import read_lines

AS_OF = dt.date(2025, 2, 1)


def put(folder, name, *rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(r + "\n" for r in rows))


def first_drop(inbox):
    """Two sales files, the second under a header line, and two store lists."""
    put(
        inbox,
        "sales_east_20250111.csv",
        "kiosk_b,b-1,q1,2025-01-11 08:15:00,$12.25,web,LEAD",
        "kiosk_a,a-1,q2,2025-01-11 08:40:00,$30.00,web,TEMP",
        "kiosk_b,b-2,q3,2025-01-11 19:00:00,$7.75,web,TEMP",
    )
    put(
        inbox,
        "weekend_sale_20250112.csv",
        "store_token,transaction_id,receipt_token,transaction_time,amount,source_id,user_role",
        "kiosk_c,c-1,41,2025-01-12T07:05:00,88.10,9,lead",
    )
    put(inbox, "store_list_20250112.csv", "store_group,store_token,store_name", "North,kiosk_c,Kiosk at the pier")
    put(inbox, "stores_closed_20250112.csv", "South,kiosk_x,Closed kiosk")


def daily(warehouse):
    rows = warehouse.daily_sales.read().orderBy("transaction_date")
    return tuples(rows, "transaction_date", "active_stores", "total_amount", "monthly_cumulative_sales", "top_store_token")


def lifecycle(warehouse):
    rows = warehouse.lifecycle.read().orderBy("batch_date")
    return tuples(rows, "batch_date", "total_raw_rows", "total_valid_rows", "total_ignored_rows")


def test_files_in_other_layouts_have_no_time_by_default(spark, tmp_path):
    first_drop(tmp_path / "inbox")
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    warehouse.land(str(tmp_path / "inbox"))
    warehouse.run(AS_OF)
    sales = warehouse.sales.read()
    assert sorted(tuples(sales, "amount", "transaction_time")) == [
        (Decimal(a), None) for a in ("7.75", "12.25", "30.00", "88.10")
    ]
    assert warehouse.stores.read().count() == 2
    assert daily(warehouse) == [] and warehouse.top_stores.read().count() == 0
    assert lifecycle(warehouse) == [(dt.date(2025, 1, 11), 3, 3, 0), (dt.date(2025, 1, 12), 2, 1, 1)]


def test_column_checks(spark, tmp_path):
    inbox = tmp_path / "inbox"
    put(inbox, "sales_20250111.csv", "a,,r,20250111T100000.000,1,clerk", "a,t1,r,20250111T100000.000,1,clerk")
    put(inbox, "stores_20250111.csv", "G,a,Old")
    put(inbox, "stores_20250112.csv", "G,a,New")
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    warehouse.land(str(inbox))
    warehouse.run_stage()
    expected = {
        ("sales", "store_token", "not_null"): 0,
        ("sales", "transaction_id", "not_null"): 1,
        ("stores", "store_token", "not_null"): 0,
        ("stores", "store_token", "unique"): 0,
    }
    for layer, duplicated in (("stage", 0), ("raw", 1), (None, 0)):
        found = {r[:3]: r[3] for r in tuples(warehouse.check(layer), "table_name", "column_name", "check", "failures")}
        assert found == {**expected, ("stores", "store_token", "unique"): duplicated}
    # Counted on the way: the raw layer is not read for it, and a batch that is landed again counts once.
    counts = read_null_counts(spark, str(tmp_path / "wh"))
    assert sorted(tuples(counts, "table_name", "column_name", "row_count", "failures")) == [
        ("sales", "store_token", 2, 0), ("sales", "transaction_id", 2, 1), ("stores", "store_token", 2, 0),
    ]
    label = next(p.name for p in (tmp_path / "wh/raw_checks").iterdir() if "=" in p.name).partition("=")[2]
    lines = read_lines(spark, str(inbox), AS_OF)
    land(lines, str(tmp_path / "wh"), label, AS_OF)
    assert sorted(r[0] for r in tuples(read_null_counts(spark, str(tmp_path / "wh")), "row_count")) == [2, 2, 2]
    os.rename(tmp_path / "wh/raw/sales", tmp_path / "gone")
    assert {r[:3]: r[3] for r in tuples(warehouse.check(), "table_name", "column_name", "check", "failures")} == expected


def test_seeded_totals_go_on_from_the_report(spark, tmp_path):
    """The total of a late row before the lookback is not in them, and no day before the lookback is read."""
    inbox = tmp_path / "inbox"
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    put(inbox, "sales_20250120.csv", *[f"a,t{d},r,202501{d}T100000.000,1.00,s,c" for d in (10, 11, 12, 13, 20)])
    warehouse.land(str(inbox))
    warehouse.run(AS_OF)
    put(inbox, "sales_20250121.csv", *[f"a,late{d},r,202501{d}T110000.000,5.00,s,c" for d in (12, 13)], "a,n,r,20250202T110000.000,7.00,s,c")
    warehouse.land(str(inbox))
    warehouse.run_stage()
    warehouse.run_daily_sales(AS_OF, seeded=True)
    assert {(r[0].month, r[0].day): int(r[3]) for r in daily(warehouse)} == {(1, 10): 1, (1, 11): 2, (1, 12): 3, (1, 13): 9, (1, 20): 10, (2, 2): 7}
    start = dt.date(2025, 1, 13)
    plan = marts.report_daily_sales(warehouse.sales.read(start), AS_OF, start, seed=warehouse.daily_sales.read())
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "transaction_time#" in text and "2025-01-13" in text and "2025-01-01 00:00:00" not in text.split("Aggregate")[-1]


def test_incremental_runs(spark, tmp_path):
    inbox = tmp_path / "inbox"
    first_drop(inbox)
    warehouse = Warehouse(spark, str(tmp_path / "wh"), [COMPACT, ISO_SPACE, ISO_T])
    warehouse.land(str(inbox))
    warehouse.run(AS_OF)
    eleven, twelve, thirteen = (dt.date(2025, 1, d) for d in (11, 12, 13))
    first = [
        (eleven, 2, Decimal("50.00"), Decimal("50.00"), "kiosk_a"),
        (twelve, 1, Decimal("88.10"), Decimal("138.10"), "kiosk_c"),
    ]
    assert daily(warehouse) == first
    top = warehouse.top_stores.read().orderBy("transaction_date", "range_top_id")
    assert tuples(top, "range_top_id", "store_token", "store_name") == [
        (1, "kiosk_a", None), (2, "kiosk_b", None), (1, "kiosk_c", "Kiosk at the pier"),
    ]

    warehouse.run(AS_OF)
    assert daily(warehouse) == first

    put(
        inbox,
        "sales_20250113.csv",
        "kiosk_b,b-2,q3,20250111T190000.000,$27.75,web,TEMP",
        "kiosk_d,d-1,q9,20250113T080000.000,$4.00,TEMP",
    )
    put(inbox, "stores_20250113.csv", "North,kiosk_a,Kiosk by the lift")
    warehouse.land(str(inbox))
    warehouse.run(AS_OF)
    second = [
        (eleven, 2, Decimal("70.00"), Decimal("70.00"), "kiosk_b"),
        (twelve, 1, Decimal("88.10"), Decimal("158.10"), "kiosk_c"),
        (thirteen, 1, Decimal("4.00"), Decimal("162.10"), "kiosk_d"),
    ]
    assert daily(warehouse) == second
    # The corrected transaction now belongs to the newer batch.
    assert lifecycle(warehouse) == [(eleven, 3, 2, 1), (twelve, 2, 1, 1), (thirteen, 2, 2, 0)]
    names = dict(tuples(warehouse.top_stores.read(), "store_token", "store_name"))
    assert names == {"kiosk_a": "Kiosk by the lift", "kiosk_b": None, "kiosk_c": "Kiosk at the pier", "kiosk_d": None}
    before = [daily(warehouse), lifecycle(warehouse), sorted(tuples(warehouse.sales.read()))]
    other = Warehouse(spark, str(tmp_path / "wh"), [COMPACT, ISO_SPACE, ISO_T])
    for table in (other.sales, other.stores, other.raw_loads, other.daily_sales, other.lifecycle):
        spark.sql(f"DROP TABLE {table.name}")  # as another session would find them
    other.run(AS_OF)
    assert [daily(other), lifecycle(other), sorted(tuples(other.sales.read()))] == before
    warehouse.run(AS_OF, full_refresh=True)
    assert [daily(warehouse), lifecycle(warehouse), sorted(tuples(warehouse.sales.read()))] == before


def test_lookback_reaches_seven_days_behind_the_newest_report_day(spark, tmp_path):
    """A late row eight days back stays out until a full refresh, one seven days back is taken."""
    inbox = tmp_path / "inbox"
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    put(inbox, "sales_20250120.csv", *[f"a,t{d},r,202501{d}T100000.000,1.00,s,c" for d in (10, 11, 12, 13, 20)])
    warehouse.land(str(inbox))
    warehouse.run(AS_OF)
    put(inbox, "sales_20250121.csv", *[f"a,late{d},r,202501{d}T110000.000,5.00,s,c" for d in (12, 13)])
    warehouse.land(str(inbox))
    warehouse.run(AS_OF)
    totals = {r[0].day: int(r[2]) for r in daily(warehouse)}
    assert totals == {10: 1, 11: 1, 12: 1, 13: 6, 20: 1}
    # The running month total counts the late row of the twelfth all the same.
    assert {r[0].day: int(r[3]) for r in daily(warehouse)} == {10: 1, 11: 2, 12: 3, 13: 14, 20: 15}
    warehouse.run(AS_OF, full_refresh=True)
    assert {r[0].day: int(r[2]) for r in daily(warehouse)} == {10: 1, 11: 1, 12: 6, 13: 6, 20: 1}


def test_a_day_that_a_correction_empties(spark, tmp_path):
    """Its report row stays until a full refresh, and the top stores still cover ten real days."""
    inbox = tmp_path / "inbox"
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    put(inbox, "sales_20250120.csv", *[f"a,t{d},r,202501{d}T100000.000,1.00,s,c" for d in range(10, 21)])
    warehouse.land(str(inbox))
    warehouse.run(AS_OF)
    put(inbox, "sales_20250121.csv", "a,t15,r,20250116T100000.000,1.00,s,c")
    warehouse.land(str(inbox))
    warehouse.run(AS_OF)
    assert 15 in {r[0].day for r in daily(warehouse)}
    days = sorted(r[0].day for r in tuples(warehouse.top_stores.read(), "transaction_date"))
    assert days == [10, 11, 12, 13, 14, 16, 17, 18, 19, 20]
    warehouse.run(AS_OF, full_refresh=True)
    assert 15 not in {r[0].day for r in daily(warehouse)}


def test_more_new_days_than_a_full_report_holds(spark, tmp_path):
    """Sixty days landed at once all reach both reports; a full refresh keeps the newest forty."""
    inbox = tmp_path / "inbox"
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    days = [dt.date(2025, 1, 1) + dt.timedelta(days=k) for k in range(63)]
    lines = [f"a,t{d},r,{d:%Y%m%d}T100000.000,1.00,s,c" for d in days]
    for part in (range(3), range(3, 63)):
        for k in part:
            put(inbox, f"sales_{days[k]:%Y%m%d}.csv", lines[k])
        warehouse.land(str(inbox))
        warehouse.run(AS_OF)
    assert [r[0] for r in daily(warehouse)] == days and [r[0] for r in lifecycle(warehouse)] == days
    warehouse.run(AS_OF, full_refresh=True)
    assert [r[0] for r in daily(warehouse)] == days[-40:] and [r[0] for r in lifecycle(warehouse)] == days[-40:]


def test_lifecycle_reads_neither_raw_nor_stage(spark, tmp_path, monkeypatch):
    inbox = tmp_path / "inbox"
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    put(inbox, "sales_20250120.csv", *[f"a,t{d},r,202501{d}T100000.000,1.00,s,c" for d in (10, 11)])
    warehouse.land(str(inbox))
    warehouse.run_stage()
    put(inbox, "sales_20250121.csv", "a,t11,r,20250111T100000.000,2.00,s,c", "store_token,,,,,,")
    warehouse.land(str(inbox))
    warehouse.run_stage()
    for layer in ("raw/sales", "stage/sales"):
        os.rename(tmp_path / "wh" / layer, tmp_path / "wh" / layer.replace("/", "-gone-"))
    warehouse.run_lifecycle(AS_OF)
    assert lifecycle(warehouse) == [(dt.date(2025, 1, 20), 2, 1, 1), (dt.date(2025, 1, 21), 2, 1, 1)]
