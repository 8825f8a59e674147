import datetime as dt
from decimal import Decimal

import pytest

from helpers import raw_sales, raw_stores, staged, tuples
from tallyhouse.operators.ranking import top_n_dense
from tallyhouse.plans import marts
from tallyhouse.plans.stage import stage_stores
from tallyhouse.schemas import REPORT_DAILY_SALES, REPORT_LIFECYCLE, REPORT_TOP_STORES

AS_OF = dt.date(2021, 2, 1)


def day(text):
    return dt.date.fromisoformat(text)


def money(text):
    return None if text is None else Decimal(text)


def test_daily_sales_by_hand(spark):
    sales = staged(
        spark,
        [
            ("a", "1", "2021-01-30T10:00", "10.00"),
            ("a", "2", "2021-01-30T23:59:59.999", "0.50"),
            ("b", "3", "2021-01-30T00:00", "20.00"),
            ("b", "4", "2021-01-31T10:00", "5.00"),
            ("b", "5", "2021-02-01T10:00", "1.00"),
            ("b", "6", None, "99.00"),
        ],
    )
    report = marts.report_daily_sales(sales, AS_OF)
    assert report.schema.simpleString() == REPORT_DAILY_SALES.simpleString()
    assert tuples(report) == [
        (AS_OF, day("2021-02-01"), 1, money("1.00"), money("1.000000"), money("1.00"), "b"),
        (AS_OF, day("2021-01-31"), 1, money("5.00"), money("5.000000"), money("35.50"), "b"),
        (AS_OF, day("2021-01-30"), 2, money("30.50"), money("15.250000"), money("30.50"), "b"),
    ]


def test_top_store_ties_and_missing_totals(spark):
    sales = staged(
        spark,
        [
            ("b", "1", "2021-01-01T10:00", "5.00"),
            ("a", "2", "2021-01-01T10:00", "5.00"),
            ("c", "3", "2021-01-01T10:00", "4.00"),
            ("z", "4", "2021-01-02T10:00", None),
            ("y", "5", "2021-01-02T10:00", "7.00"),
            ("x", "6", "2021-01-02T10:00", None),
            ("w", "7", "2021-01-03T10:00", None),
            ("v", "8", "2021-01-04T10:00", "-5.00"),
            ("u", "9", "2021-01-04T10:00", "-4.00"),
        ],
    )
    days = marts.daily_store_sales(sales)
    first = {1: "a", 2: "x", 3: "w", 4: "u"}
    last = {1: "a", 2: "y", 3: "w", 4: "u"}
    for nulls, expected in (("first", first), ("last", last)):
        windowed = marts.top_store_per_day(days, nulls)
        assert {r[0].day: r[1] for r in tuples(windowed)} == expected
        summary = marts.daily_summary(days, nulls)
        assert {r[0].day: r[1] for r in tuples(summary, "transaction_date", "top_store_token")} == expected
    stats = {r[0].day: r[1:] for r in tuples(marts.daily_stats(days))}
    assert stats[2] == (3, money("7.00"), money("7.000000"))
    assert stats[3] == (1, None, None)
    with pytest.raises(ValueError):
        marts.report_daily_sales(sales, AS_OF, nulls_rank="middle").collect()


def test_daily_sales_keeps_forty_days(spark):
    start = dt.datetime(2021, 1, 1)
    sales = staged(
        spark, [("a", str(i), (start + dt.timedelta(days=i)).isoformat(), "1") for i in range(60)]
    )
    dates = [r[0] for r in tuples(marts.report_daily_sales(sales, AS_OF), "transaction_date")]
    assert dates == [day("2021-03-01") - dt.timedelta(days=i) for i in range(40)]
    assert marts.report_daily_sales(sales, AS_OF, limit=None).count() == 60


def test_lookback_keeps_the_running_total_of_the_month(spark):
    start = dt.datetime(2021, 1, 1)
    sales = staged(
        spark, [("a", str(i), (start + dt.timedelta(days=i)).isoformat(), "1") for i in range(40)]
    )
    full = {r[0]: r[1] for r in tuples(marts.report_daily_sales(sales, AS_OF), "transaction_date", "monthly_cumulative_sales")}
    since = day("2021-01-20")
    frame = spark.createDataFrame([(since,)], "start date")
    for bound in (since, frame):
        anchored = marts.report_daily_sales(sales, AS_OF, bound)
        got = {r[0]: r[1] for r in tuples(anchored, "transaction_date", "monthly_cumulative_sales")}
        assert got == {d: v for d, v in full.items() if d >= since}
    restarted = marts.report_daily_sales(sales, AS_OF, since, month_anchored=False)
    got = {r[0]: r[1] for r in tuples(restarted, "transaction_date", "monthly_cumulative_sales")}
    assert got[since] == money("1.00") and got[day("2021-02-09")] == money("9.00")
    assert min(got) == since


def test_top_stores_ties_share_a_rank(spark):
    amounts = {"a": 9, "b": 8, "c": 7, "d": 6, "e": 5, "f": 5, "g": 5, "h": 4}
    rows = [(s, "1", "2021-01-01T10:00", v) for s, v in amounts.items()]
    rows += [("a", "2", "2021-01-02T10:00", None), ("b", "3", "2021-01-02T10:00", 1)]
    stores = stage_stores(raw_stores(spark, [{"store_token": "a", "store_name": "Alpha"}]))
    report = marts.report_top_stores(staged(spark, rows), stores, AS_OF)
    assert report.schema.simpleString() == REPORT_TOP_STORES.simpleString()
    assert tuples(report, "transaction_date", "range_top_id", "store_token", "store_name") == [
        (day("2021-01-02"), 1, "a", "Alpha"),
        (day("2021-01-02"), 2, "b", None),
        (day("2021-01-01"), 1, "a", "Alpha"),
        (day("2021-01-01"), 2, "b", None),
        (day("2021-01-01"), 3, "c", None),
        (day("2021-01-01"), 4, "d", None),
        (day("2021-01-01"), 5, "e", None),
        (day("2021-01-01"), 5, "f", None),
        (day("2021-01-01"), 5, "g", None),
    ]


def test_top_stores_covers_the_last_ten_dates_with_sales(spark):
    rows = [("a", str(i), f"2021-01-{i:02d}T10:00", 1) for i in range(1, 29, 2)]
    report = marts.report_top_stores(staged(spark, rows), stage_stores(raw_stores(spark, [{}])), AS_OF)
    assert [r[0].day for r in tuples(report, "transaction_date")] == list(range(27, 8, -2))


def test_top_n_equals_dense_rank(spark):
    rows = spark.range(3000).selectExpr(
        "id % 7 as g", "case when id % 3 = 0 then null else cast(pmod(xxhash64(id), 40) as int) end as m", "id"
    )
    rows = rows.unionByName(spark.sql("select null as g, 5 as m, 1L as id union all select null, null, 2L"))
    rows.createOrReplaceTempView("rank_rows")
    expected = spark.sql(
        """select * from (select *, dense_rank() over (partition by g order by m desc nulls first) as ranking
           from rank_rows) where ranking <= 5"""
    )
    for bound in (None, 8):
        got = top_n_dense(rows, "g", "m", 5, max_groups=bound)
        assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_lifecycle_by_hand(spark):
    raw = raw_sales(
        spark,
        [{"batch_date": day("2021-01-01")}] * 3
        + [{"batch_date": day("2021-01-03")}]
        + [{"batch_date": None}],
    )
    sales = staged(
        spark,
        [
            ("a", "1", None, 1, "2021-01-01"),
            ("a", "2", None, 1, "2021-01-02"),
            ("a", "3", None, 1, "2021-01-02"),
        ],
    ).withColumnRenamed("x", "x")
    report = marts.report_transactions_lifecycle(raw, sales, AS_OF)
    assert report.schema.simpleString() == REPORT_LIFECYCLE.simpleString()
    got = tuples(report, "batch_date", "total_raw_rows", "total_valid_rows", "total_ignored_rows")
    assert got == [
        (None, 1, 0, 1),
        (day("2021-01-03"), 1, 0, 1),
        (day("2021-01-02"), 0, 2, -2),
        (day("2021-01-01"), 3, 1, 2),
    ]
    assert report.first().processing_date is None
    recent = marts.report_transactions_lifecycle(raw, sales, AS_OF, day("2021-01-02"))
    assert tuples(recent, "batch_date", "total_raw_rows", "total_valid_rows", "total_ignored_rows") == got[1:3]
