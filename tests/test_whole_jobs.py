"""Queries over rows of our own: whole results, and work that is spread over tasks."""

import datetime as dt
import glob
import re

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from tallyhouse.checks import fixtures, queries
from tallyhouse.checks.compare import difference
from tallyhouse.checks.queries import QUERIES, _write_inbox
from tallyhouse.sources import keyed

LINEITEM = """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double,
    l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"""


def write_lines(spark, folder, orders, same_day=False):
    """A line of each order, on a day of its own unless `same_day` is set, and one supplier."""
    first = dt.datetime(2000, 1, 2)
    rows = [
        (k, k, 1, 1, 1.0, 10.0, 0.0, 0.0, "N", "O", first if same_day else first + dt.timedelta(days=n)) for n, k in enumerate(orders)
    ]
    spark.createDataFrame(rows, LINEITEM).write.parquet(f"{folder}/lineitem.parquet")
    spark.sql("SELECT 1L AS s_suppkey, 'one' AS s_name, 1L AS s_nationkey").write.parquet(f"{folder}/supplier.parquet")
    spark.sql("SELECT 1L AS n_nationkey, 'somewhere' AS n_name").write.parquet(f"{folder}/nation.parquet")


def sql_of(folder):
    """Views of the three tables for the SQL of a query."""
    import duckdb

    con = duckdb.connect()
    for table in ("lineitem", "supplier", "nation"):
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    return con


def test_raw_sales_keeps_files_of_every_order_but_a_few(spark, tmp_path):
    """Only orders divisible by 4999 or 4993 spoil their files."""
    folder = str(tmp_path)
    write_lines(spark, folder, [*range(488, 502), *range(980, 1000), *range(4990, 5002)])
    got = {row.transaction_id for row in QUERIES["raw_sales"](spark, folder).where("store_token = 'store_1'").collect()}
    assert got == {f"{k}-1" for k in [*range(488, 502), *range(980, 1000), *range(4990, 5002)] if k not in (4993, 4999)}
    assert difference(spark, sql_of(folder), folder, "raw_sales")[1] == ""


def test_dq_not_null_checks_the_rows_of_nearly_all_files(spark, tmp_path):
    """Orders divisible by 83 have short lines without a role; those divisible by 491 or 499 count as well."""
    folder = str(tmp_path)
    write_lines(spark, folder, [83, 491 * 83, 499 * 83])
    found = {row.column_name: row.failures for row in QUERIES["dq_not_null"](spark, folder).where("table_name = 'sales'").collect()}
    assert found["user_role"] == 3


def test_dq_not_null_leaves_out_files_of_a_fifth_only(spark, tmp_path):
    """Lines without a receipt: those of orders divisible by 4999 or 4993 count too, unless a bad line lies in a file of a fifth."""
    folder = str(tmp_path)
    open_quote, tail, other = 37 * 4999, 74 * 4999, 37 * 4993
    write_lines(spark, folder, [open_quote, tail, other, open_quote, *range(1, 31), tail])  # January 5 is the 4th, February 5 the last
    found = {row.column_name: row.failures for row in QUERIES["dq_not_null"](spark, folder).where("table_name = 'sales'").collect()}
    assert found["receipt_token"] == 3
    assert difference(spark, sql_of(folder), folder, "dq_not_null")[1] == ""


def test_dq_not_null_checks_the_stores_of_nearly_all_lines(spark, tmp_path, monkeypatch):
    """Only lines of suppliers divisible by 13 and not by 11 are bad; the header is a row too."""
    folder = str(tmp_path)
    write_lines(spark, folder, [1])
    suppliers = spark.range(1, 301).selectExpr("id AS s_suppkey", "'one' AS s_name", "1L AS s_nationkey")
    suppliers.write.mode("overwrite").parquet(f"{folder}/supplier.parquet")
    rows = lambda df, columns: df.agg(F.count("*").alias("failures")).withColumn("column_name", F.lit("rows"))
    monkeypatch.setattr(queries.quality, "not_null", rows)
    (found,) = QUERIES["dq_not_null"](spark, folder).where("table_name = 'stores'").collect()
    assert found.failures == 1 + sum(k % 11 == 0 or k % 13 != 0 for k in range(1, 301))


def test_no_task_reads_all_lines_for_the_bad_drop(spark, tmp_path, monkeypatch):
    """The one file of bad lines is written by one task, and every task of the scan looks for them."""

    def lines(spark, _):
        task = F.udf(lambda _: f"A,x,{TaskContext.get().taskAttemptId()}")("id")
        return spark.range(0, 80, 1, 4).select(task.alias("value"), (F.col("id") % 2 == 0).alias("bad"))

    monkeypatch.setattr(fixtures, "sales_lines", lines)
    monkeypatch.setattr(fixtures, "store_lines", lines)
    _write_inbox(spark, "", f"{tmp_path}/inbox")
    (found,) = glob.glob(f"{tmp_path}/inbox/sales_20250113*")
    with open(found) as f:
        read = f.read().splitlines()
    assert len(read) == 40 and len(set(read)) == 4


UPSERTS = "upsert_merge full_refresh_equivalence lifecycle_rollup stream_upsert stream_daily_report stream_lifecycle_report".split()


@pytest.mark.parametrize("name", UPSERTS)
def test_the_stage_has_as_many_buckets_as_its_rows_need(spark, tmp_path, monkeypatch, name):
    """A task of an upsert holds a bucket, so buckets keep their size and grow in number."""
    folder = str(tmp_path)
    write_lines(spark, folder, range(1, 101), same_day=True)
    monkeypatch.setattr(keyed, "ROWS_PER_BUCKET", 10, raising=False)
    monkeypatch.setattr(queries, "scratch_dir", lambda spark, label: f"{folder}/scratch")
    assert difference(spark, sql_of(folder), folder, name)[1] == ""
    files = glob.glob(f"{folder}/scratch/stage/*/part-*.parquet")
    buckets = {int(re.search(r"_(\d{5})\.", f).group(1)) for f in files}
    assert len(buckets) > 4 and max(buckets) < 10
    assert [keyed.buckets_for(n) for n in (0, 40, 41)] == [4, 4, 5]
