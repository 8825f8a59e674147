import datetime as dt
from decimal import Decimal

from helpers import at, raw_sales, raw_stores, tuples
from tallyhouse.plans.stage import stage_sales, stage_stores
from tallyhouse.schemas import STAGE_SALES, STAGE_STORES


def test_schemas(spark):
    assert stage_sales(raw_sales(spark, [{}])).schema.simpleString() == STAGE_SALES.simpleString()
    assert stage_stores(raw_stores(spark, [{}])).schema.simpleString() == STAGE_STORES.simpleString()


def test_headers_and_missing_stores_go_and_text_is_trimmed(spark):
    rows = [
        {"store_token": "store_token", "transaction_id": "transaction_id"},
        {"store_token": None},
        {"store_token": " store_token", "transaction_id": "kept"},
        {"store_token": " a ", "transaction_id": " t ", "amount": " $3.10 ", "user_role": "\tx "},
    ]
    staged = stage_sales(raw_sales(spark, rows))
    assert sorted(tuples(staged, "store_token", "transaction_id", "amount", "user_role")) == [
        ("a", "t", Decimal("3.10"), "\tx"),
        ("store_token", "kept", Decimal("1.00"), "clerk"),
    ]


def test_latest_load_wins_then_file_time_then_file_name_then_payload(spark):
    later = at("2021-01-06 00:00:00")
    rows = [
        {"transaction_id": "load", "amount": "1"},
        {"transaction_id": "load", "amount": "2", "loaded_at": later},
        {"transaction_id": "null load", "amount": "1", "loaded_at": later},
        {"transaction_id": "null load", "amount": "2", "loaded_at": None},
        {"transaction_id": "file time", "amount": "1", "file_modified_at": later},
        {"transaction_id": "file time", "amount": "2"},
        {"transaction_id": "file name", "amount": "1", "source_filename": "b"},
        {"transaction_id": "file name", "amount": "2", "source_filename": "a"},
        {"transaction_id": "payload", "amount": "1", "receipt_token": "r2"},
        {"transaction_id": "payload", "amount": "2", "receipt_token": "r1"},
        {"transaction_id": None, "amount": "1"},
        {"transaction_id": None, "amount": "2"},
    ]
    staged = stage_sales(raw_sales(spark, rows))
    assert {r[0]: int(r[1]) for r in tuples(staged, "transaction_id", "amount")} == {
        "load": 2,
        "null load": 2,
        "file time": 1,
        "file name": 1,
        "payload": 1,
        None: 2,
    }
    assert staged.count() == 6


def test_same_transaction_in_two_stores_stays_twice(spark):
    rows = [{"store_token": "a"}, {"store_token": "b"}, {"store_token": " a"}]
    assert stage_sales(raw_sales(spark, rows)).count() == 2


def test_one_key_that_holds_most_rows(spark):
    """The hot key is cut to one row per task before the shuffle."""
    raw = raw_sales(spark, [{}]).drop("loaded_at", "transaction_id")
    many = spark.range(0, 20000, 1, 8).selectExpr(
        "case when id % 3 = 0 then 'hot' else cast(id as string) end as transaction_id",
        "timestamp_ntz'2021-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) as loaded_at",
    )
    staged = stage_sales(many.crossJoin(raw))
    assert staged.count() == 13334
    newest = dt.datetime(2021, 1, 1) + dt.timedelta(seconds=19998)
    assert staged.filter("transaction_id = 'hot'").first().loaded_at == newest


def test_stores_keep_the_latest_name(spark):
    rows = [
        {"store_name": " old "},
        {"store_name": " new ", "loaded_at": at("2021-02-01 00:00:00")},
        {"store_token": "store_token", "store_name": "store_name"},
        {"store_token": "s2", "store_group": " h"},
    ]
    assert sorted(tuples(stage_stores(raw_stores(spark, rows)), "store_token", "store_group", "store_name")) == [
        ("s1", "g", "new"),
        ("s2", "h", "name"),
    ]
