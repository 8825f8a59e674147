"""Raw tables, CSV lines and file names derived from the given tables.

Each text below is valid for both engines once its slots are filled.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.clock import clock_literal
from tallyhouse.session import scratch_dir

AS_OF = dt.date(2025, 1, 31)
SPLIT = dt.datetime(2001, 1, 1)

SPARK = {
    "S": "string",
    "N": "_ntz",
    "ISO": "date_format(l_shipdate, 'yyyy-MM-dd')",
    "COMPACT": "date_format(l_shipdate, \"yyyyMMdd'T'HHmmss.SSS\")",
    "DIGITS": "date_format(l_shipdate, 'yyyyMMdd')",
    "ORDER_DIGITS": "date_format(o_orderdate, 'yyyyMMdd')",
}
DUCKDB = {
    "S": "varchar",
    "N": "",
    "ISO": "strftime(l_shipdate, '%Y-%m-%d')",
    "COMPACT": "strftime(l_shipdate, '%Y%m%dT%H%M%S.%g')",
    "DIGITS": "strftime(l_shipdate, '%Y%m%d')",
    "ORDER_DIGITS": "strftime(o_orderdate, '%Y%m%d')",
}

RAW_SALES_SQL = """
select case when l_orderkey % 41 = 0 then '  ' else '' end || case when l_orderkey % 10 = 3 then 'gone_' else 'store_' end ||
       cast(l_suppkey as <S>) as store_token,
       cast(l_orderkey % 200 as <S>) || '-' || cast(l_linenumber as <S>) as transaction_id,
       cast(l_partkey as <S>) as receipt_token,
       case when l_orderkey % 97 = 0 then <ISO> else <COMPACT> end as transaction_time,
       case when l_partkey % 53 = 0 then 'N/A'
            when l_partkey % 2 = 0 then '$' || cast(cast(l_extendedprice as decimal(11,2)) as <S>)
            else cast(cast(l_extendedprice as decimal(11,2)) as <S>) end as amount,
       l_returnflag as source_id, l_linestatus as user_role,
       cast(l_shipdate as date) as batch_date, l_shipdate as loaded_at
from lineitem
union all
select 'store_token', 'transaction_id', 'receipt_token', 'transaction_time', 'amount', 'source_id', 'user_role',
       cast(l_shipdate as date), l_shipdate
from (select distinct l_shipdate from lineitem) h where extract(day from l_shipdate) = 1
"""

RAW_STORES_SQL = """
select n_name as store_group, 'store_' || cast(s_suppkey as <S>) as store_token, ' ' || s_name as store_name,
       date '2025-01-01' as batch_date, timestamp<N> '2025-01-01 00:00:00' as loaded_at
from supplier join nation on s_nationkey = n_nationkey
union all
select n_name, 'store_' || cast(s_suppkey as <S>), s_name || ' v2', date '2025-01-02',
       timestamp<N> '2025-01-02 00:00:00'
from supplier join nation on s_nationkey = n_nationkey where s_suppkey % 3 = 0
union all
select 'store_group', 'store_token', 'store_name', date '2025-01-02', timestamp<N> '2025-01-02 00:00:00'
"""

# The logical fields of each sales line and the shape the line is written in.
SALES_DROPS_SQL = """
select l_orderkey as k, l_shipdate, <DIGITS> as digits,
       'store_' || cast(l_suppkey as <S>) as f1,
       cast(l_orderkey as <S>) || '-' || cast(l_linenumber as <S>) as f2,
       case when l_orderkey % 29 = 0 then 'rec, "x" ' || cast(l_partkey as <S>)
            when l_orderkey % 37 = 0 then 'NULL'
            when l_orderkey % 43 = 0 then 'null'
            when l_orderkey % 47 = 0 then ''
            when l_orderkey % 53 = 0 then '5" pipe ' || cast(l_partkey as <S>)
            else cast(l_partkey as <S>) end as f3,
       <COMPACT> as f4,
       '$' || cast(cast(l_extendedprice as decimal(11,2)) as <S>) as f5,
       l_returnflag as source, l_linestatus as job,
       case when l_orderkey % 499 = 0 and l_linenumber = 1 then 'open'
            when l_orderkey % 491 = 0 and l_linenumber = 1 then 'tail'
            when l_orderkey % 83 = 0 then 'short'
            when l_orderkey % 59 = 0 then 'wide'
            when l_orderkey % 31 = 0 then 'norole'
            when l_linenumber % 2 = 1 then 'six'
            else 'seven' end as shape
from lineitem
"""

# The same lines with a tenth of the bad ones: a bad line turns its whole file away, and nearly all files are to land.
FEW_BAD_DROPS_SQL = SALES_DROPS_SQL.replace("% 499 ", "% 4999 ").replace("% 491 ", "% 4993 ")

# The lines that are checked for missing values: only files of a fifth of the month can hold bad ones, some of those of orders divisible
# by 4999, so that one file in thirty is turned away at most, however many lines a file has.
FIFTH_BAD_DROPS_SQL = SALES_DROPS_SQL.replace("% 499 = 0", "% 9998 = 4999 and extract(day from l_shipdate) = 5").replace(
    "% 491 = 0", "% 9998 = 0 and extract(day from l_shipdate) = 5"
)

SALES_LINES_SQL = """
select f1 || ',' || f2 || ',' ||
       case when k % 29 = 0 then '"' || replace(f3, '"', '""') || '"' else f3 end ||
       case when shape = 'short' then '' else ',' || f4 || ',' || f5 end ||
       case shape when 'short' then '' when 'six' then ',' || job when 'seven' then ',' || source || ',' || job
                  when 'norole' then ',' || source || ',' when 'wide' then ',' || source || ',' || job || ',extra'
                  when 'open' then ',' || source || ',"' || job else ',' || source || ',"' || job || '"x' end as value,
       digits, shape in ('open', 'tail') as bad
from ({drops}) d
union all
select 'store_token,transaction_id,receipt_token,transaction_time,amount,source_id,user_role', digits, false
from (select distinct l_shipdate, digits from ({drops}) d) h where extract(day from l_shipdate) = 1
"""

STORE_LINES_SQL = """
select case when s_suppkey % 7 = 0 then '"' || n_name || ', Ltd"' else n_name end || ',store_' ||
       cast(s_suppkey as <S>) || case when s_suppkey % 11 = 0 then '' when s_suppkey % 13 = 0 then ',"' || s_name
                                      when s_suppkey % 17 = 0 then ',"' || s_name || '"x'
                                      else ',' || s_name || case when s_suppkey % 5 = 0 then ',x' when s_suppkey % 5 = 1
                                      then ' 5"' else '' end end
       as value, cast(n_nationkey as <S>) as part,
       s_suppkey % 11 <> 0 and (s_suppkey % 13 = 0 or s_suppkey % 17 = 0) as bad
from supplier join nation on s_nationkey = n_nationkey
union all
select 'store_group,store_token,store_name', cast(n_nationkey as <S>), false from nation
"""

# The same lines, bad ones of both kinds for suppliers divisible by 13 only.
FEW_BAD_STORE_LINES_SQL = STORE_LINES_SQL.replace("% 13 ", "% 26 ").replace("% 17 ", "% 13 ")

FILE_NAMES_SQL = """
select o_orderkey,
       case cast(o_orderkey % 8 as int)
            when 0 then 'inbox/sales_' || <ORDER_DIGITS> || '.csv'
            when 1 then 'inbox/STORES_' || <ORDER_DIGITS> || '.CSV'
            when 2 then 'inbox/store_sales_' || <ORDER_DIGITS> || '.csv'
            when 3 then 'drop/inbox/2025/daily-Sale-' || <ORDER_DIGITS> || '0001.csv'
            when 4 then 'outbox/sales_' || <ORDER_DIGITS> || '.csv'
            when 5 then 'inbox/stores/other_' || <ORDER_DIGITS> || '.csv'
            when 6 then 'inbox/sales_99999999.csv'
            else 'inbox/sales/' end as file_key
from orders
"""


def fill(sql: str, slots: dict[str, str]) -> str:
    for slot, text in slots.items():
        sql = sql.replace(f"<{slot}>", text)
    return sql


def run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a fixture text in Spark on the tables of one folder."""
    names = [name for name in ("lineitem", "supplier", "nation", "orders") if name in sql]
    text = fill(sql, SPARK)
    for name in names:
        text = text.replace(f"from {name}", f"from {{{name}}}").replace(f"join {name}", f"join {{{name}}}")
    return spark.sql(text, **{name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names})


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, RAW_SALES_SQL)


def raw_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, RAW_STORES_SQL)


def _as_lines(spark: SparkSession, values: DataFrame, path) -> DataFrame:
    """Lines with their file, read back from a written table.

    A line is a long text expression. Left in the plan it would be copied into every place that
    looks at the line, and the generated code would grow too large to be compiled.
    """
    folder = scratch_dir(spark, "lines")
    values.select("value", path.alias("file_path"), "bad").write.parquet(folder)
    return spark.read.schema("value string, file_path string, bad boolean").parquet(folder).select(
        "value",
        "file_path",
        "bad",
        clock_literal("2025-01-31 12:00:00").alias("file_modified_at"),
        clock_literal("2025-01-31 13:00:00").alias("loaded_at"),
    )


def sales_lines(spark: SparkSession, sf_dir: str, drops: str = SALES_DROPS_SQL) -> DataFrame:
    """CSV lines in one sales file per ship day, with the lineage a file read would give, and whether a line is bad."""
    values = run(spark, sf_dir, SALES_LINES_SQL.replace("{drops}", drops))
    return _as_lines(spark, values, F.concat(F.lit("inbox/sales_"), F.col("digits"), F.lit(".csv")))


def store_lines(spark: SparkSession, sf_dir: str, lines: str = STORE_LINES_SQL) -> DataFrame:
    """CSV lines in one stores file per nation."""
    values = run(spark, sf_dir, lines)
    return _as_lines(spark, values, F.concat(F.lit("inbox/stores_20250112_"), F.col("part"), F.lit(".csv")))


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, FILE_NAMES_SQL)


def write_drop(lines: DataFrame, folder: str, name: str) -> None:
    """Write lines as text files whose base names start with `name`."""
    lines.select("value").write.mode("append").option("mapreduce.output.basename", name).text(folder)
