import datetime as dt

from pyspark.sql import functions as F

from tallyhouse.functions.files import archive_parts, batch_date, in_inbox, route_file

TODAY = dt.date(2025, 1, 31)


def read(spark, paths, function):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("p"))).collect()]


def test_store_rule_goes_before_sale_rule(spark):
    paths = [
        "inbox/store_sales_20250101.csv",
        "inbox/SALES.csv",
        "inbox/Stores_1.csv",
        "inbox/other.csv",
        "stores/inbox/x.csv",
        "inbox/a/sales_20250101.csv",
    ]
    assert read(spark, paths, route_file) == ["stores", "transactions", "stores", None, None, "transactions"]


def test_inbox(spark):
    assert read(spark, ["inbox/a.csv", "x/inbox/a/b.csv", "inbox/", "in/a.csv", "inbox"], in_inbox) == [
        True, True, False, False, False,
    ]


def test_batch_date(spark):
    paths = [
        "inbox/sales_20250110.csv",
        "inbox/sales.csv",
        "inbox/sales_99999999.csv",
        "inbox/20240101/sales_202501104.csv",
        "inbox/sales_2025-01-10.csv",
        "inbox/sales_20250230.csv",
    ]
    ten = dt.date(2025, 1, 10)
    assert read(spark, paths, lambda p: batch_date(p, TODAY)) == [ten, TODAY, None, ten, TODAY, None]


def test_batch_date_falls_back_to_current_date(spark):
    row = spark.range(1).select(batch_date(F.lit("inbox/sales.csv")) == F.current_date())
    assert row.first()[0]


def test_archive_parts(spark):
    at = F.lit("2025-03-04 10:00:00").cast("timestamp_ntz")
    row = spark.range(1).select(*[c.alias(k) for k, c in archive_parts(at).items()]).first()
    assert tuple(row) == ("2025", "03", "04")
