from helpers import raw_sales, raw_stores, tuples
from tallyhouse.operators.quality import duplicates, not_null, unique


def test_not_null(spark):
    raw = raw_sales(spark, [{}, {"store_token": None}, {"transaction_id": None}, {"transaction_id": None}])
    found = not_null(raw, ["store_token", "transaction_id", "amount"])
    assert dict(tuples(found)) == {"store_token": 1, "transaction_id": 2, "amount": 0}
    assert dict(tuples(not_null(raw.limit(0), ["store_token"]))) == {"store_token": 0}


def test_unique_ignores_nulls(spark):
    raw = raw_stores(spark, [{"store_token": t} for t in ("a", "b", "a", "a", None, None)])
    assert tuples(duplicates(raw, "store_token")) == [("a", 3)]
    assert tuples(unique(raw, "store_token")) == [("store_token", 1)]
    assert tuples(unique(raw.limit(0), "store_token")) == [("store_token", 0)]
