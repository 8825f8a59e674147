import datetime as dt

from tallyhouse.schemas import RAW_SALES, RAW_STORES, STAGE_SALES


def at(text):
    return dt.datetime.fromisoformat(text)


def compact(text):
    """A wall-clock time in the partner layout."""
    return at(text).strftime("%Y%m%dT%H%M%S.000")


def raw_sales(spark, rows):
    """Rows as dicts over defaults."""
    base = {
        "store_token": "s1",
        "transaction_id": "t1",
        "receipt_token": "r1",
        "transaction_time": "20210105T100000.000",
        "amount": "1.00",
        "source_id": "src",
        "user_role": "clerk",
        "source_filename": "inbox/sales.csv",
        "file_modified_at": at("2021-01-05 12:00:00"),
        "batch_date": dt.date(2021, 1, 5),
        "loaded_at": at("2021-01-05 13:00:00"),
    }
    return spark.createDataFrame([tuple({**base, **row}.values()) for row in rows], RAW_SALES)


def raw_stores(spark, rows):
    base = {
        "store_group": "g",
        "store_token": "s1",
        "store_name": "name",
        "source_filename": "inbox/stores.csv",
        "file_modified_at": at("2021-01-05 12:00:00"),
        "batch_date": dt.date(2021, 1, 5),
        "loaded_at": at("2021-01-05 13:00:00"),
    }
    return spark.createDataFrame([tuple({**base, **row}.values()) for row in rows], RAW_STORES)


def staged(spark, rows):
    """Stage rows from (store, transaction, time or None, amount or None, batch day or None)."""
    from decimal import Decimal

    full = [
        (
            store,
            txn,
            "r",
            at(time) if time else None,
            None if amount is None else Decimal(str(amount)).quantize(Decimal("0.01")),
            "src",
            "clerk",
            dt.date.fromisoformat(batch[0]) if batch else dt.date(2021, 1, 1),
            at("2021-01-05 13:00:00"),
        )
        for store, txn, time, amount, *batch in rows
    ]
    return spark.createDataFrame(full, STAGE_SALES)


def tuples(df, *columns):
    return [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
