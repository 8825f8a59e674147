"""SQL for DuckDB that gives the rows of each query, written from the meaning of the report."""

from __future__ import annotations

from tallyhouse.checks.fixtures import (
    AS_OF,
    DUCKDB,
    FEW_BAD_DROPS_SQL,
    FIFTH_BAD_DROPS_SQL,
    FILE_NAMES_SQL,
    RAW_SALES_SQL,
    RAW_STORES_SQL,
    SALES_DROPS_SQL,
    SPLIT,
    STORE_LINES_SQL,
    fill,
)
from tallyhouse.checks.queries import BUILT_TO, GAP_FROM

AS_OF_SQL = f"date '{AS_OF}'"

RAW = fill(RAW_SALES_SQL, DUCKDB)
RAW_STORES = fill(RAW_STORES_SQL, DUCKDB)
DROPS = fill(SALES_DROPS_SQL, DUCKDB)
FEW_BAD_DROPS = fill(FEW_BAD_DROPS_SQL, DUCKDB)
FIFTH_BAD_DROPS = fill(FIFTH_BAD_DROPS_SQL, DUCKDB)
STORE_LINES = fill(STORE_LINES_SQL, DUCKDB)
FILE_NAMES = fill(FILE_NAMES_SQL, DUCKDB)


def _clean(source: str) -> str:
    return f"""
    select trim(store_token) as store_token, trim(transaction_id) as transaction_id,
           trim(receipt_token) as receipt_token,
           try_strptime(transaction_time, '%Y%m%dT%H%M%S.%g') as transaction_time,
           try_cast(replace(amount, '$', '') as decimal(11,2)) as amount,
           trim(source_id) as source_id, trim(user_role) as user_role, batch_date, loaded_at
    from ({source}) s where store_token <> 'store_token'"""


def _stage(source: str) -> str:
    return f"""
    select store_token, transaction_id, receipt_token, transaction_time, amount, source_id, user_role,
           batch_date, loaded_at
    from (select *, row_number() over (partition by store_token, transaction_id
              order by loaded_at desc nulls first, receipt_token desc nulls last, transaction_time desc nulls last,
                       amount desc nulls last, source_id desc nulls last, user_role desc nulls last,
                       batch_date desc nulls last) as rn
          from ({_clean(source)}) c) r where rn = 1"""


STAGE = _stage(RAW)
STAGE_STORES = f"""
    select store_token, store_group, store_name, batch_date, loaded_at
    from (select *, row_number() over (partition by store_token order by loaded_at desc nulls first,
              store_group desc, store_name desc, batch_date desc) as rn
          from (select trim(store_token) as store_token, trim(store_group) as store_group,
                       trim(store_name) as store_name, batch_date, loaded_at
                from ({RAW_STORES}) s where store_token <> 'store_token') c) r where rn = 1"""

STAGE_PLAIN = """select store_token, transaction_id, receipt_token, transaction_time, cast(amount as varchar) as amount,
    source_id, user_role, batch_date, loaded_at from ({}) s"""

STORE_DAYS = f"""
    select cast(transaction_time as date) as transaction_date, store_token, sum(amount) as store_daily_sales
    from ({STAGE}) s where transaction_time is not null group by 1, 2"""

# Mean to six decimals, half up, in whole numbers: exact for any sum.
MEAN = """cast(cast((2 * cast(sum(store_daily_sales) * 100 as hugeint) * 10000 + count(store_daily_sales))
                // nullif(2 * count(store_daily_sales), 0) as decimal(30,0)) * cast(0.000001 as decimal(7,6)) as varchar)"""

STATS = f"""
    select transaction_date, count(distinct store_token) as active_stores, sum(store_daily_sales) as total_amount,
           {MEAN} as avg_store_sales
    from ({STORE_DAYS}) d group by 1"""

TOP = f"""
    select transaction_date, min(store_token) as top_store_token
    from (select *, rank() over (partition by transaction_date order by store_daily_sales desc nulls first) as rnk
          from ({STORE_DAYS}) d) r where rnk = 1 group by 1"""

RUNNING = f"""
    select transaction_date, cast(total_amount as varchar) as total_amount,
           cast(sum(total_amount) over (partition by date_trunc('month', transaction_date)
                                        order by transaction_date) as varchar) as monthly_cumulative_sales
    from ({STATS}) s"""

DAILY = f"""
    select {AS_OF_SQL} as snapshot_date, s.transaction_date, s.active_stores, r.total_amount, s.avg_store_sales,
           r.monthly_cumulative_sales, t.top_store_token
    from ({STATS}) s join ({RUNNING}) r on s.transaction_date = r.transaction_date
    left join ({TOP}) t on s.transaction_date = t.transaction_date"""

RANKED = f"""
    select *, dense_rank() over (partition by transaction_date order by store_daily_sales desc nulls first) as ranking
    from ({STORE_DAYS}) d"""

LAST_DATES = f"""
    select distinct cast(transaction_time as date) as transaction_date from ({STAGE}) s
    where transaction_time is not null order by 1 desc limit 10"""

RAW_STATS = f"select batch_date, count(*) as total_raw_rows from ({RAW}) r group by 1"
VALID_STATS = f"""select batch_date, count(*) as total_valid_rows, max(loaded_at) as processing_date
    from ({STAGE}) s group by 1"""
# Landed rows count as one each and current rows are taken off again; rows without a batch date match no other side.
LIFECYCLE = f"""
    select batch_date, cast(sum(landed) as bigint) as total_raw_rows, cast(sum(current) as bigint) as total_valid_rows,
           cast(sum(landed - current) as bigint) as total_ignored_rows, max(staged_at) as processing_date
    from (select batch_date, 1 as landed, 0 as current, null as staged_at, 'landed' as side from ({RAW}) l
          union all select batch_date, 0, 1, loaded_at, 'staged' from ({STAGE}) s) rows_of_both
    group by batch_date, case when batch_date is null then side end"""

HEADER_FIELDS = [
    "store_token",
    "transaction_id",
    "receipt_token",
    "transaction_time",
    "amount",
    "source_id",
    "user_role",
]


# The fields each line holds, stated from its logical values rather than by splitting text.
def _fields(drops: str) -> str:
    return f"""
    select digits, shape, f1 as c1, f2 as c2, nullif(f3, '') as c3,
           case when shape = 'short' then null else f4 end as c4,
           case when shape = 'short' then null else f5 end as c5,
           case shape when 'short' then null when 'six' then job else source end as c6,
           case when shape in ('seven', 'wide') then job when 'open' = shape then '"' || job
                when shape = 'tail' then '"' || job || '"x' end as c7
    from ({drops}) d
    union all
    select digits, 'seven', {", ".join(f"'{name}'" for name in HEADER_FIELDS)}
    from (select distinct l_shipdate, digits from ({drops}) d) h where extract(day from l_shipdate) = 1"""


NO_TOKEN = "case when c3 in ('NULL', 'null') then null else c3 end"


def _landed(drops: str) -> str:
    return f"""
    select digits, shape, c1 as store_token, c2 as transaction_id, {NO_TOKEN} as receipt_token, c4 as transaction_time,
           c5 as amount, case when c7 is not null then c6 end as source_id, coalesce(c7, c6) as user_role
    from ({_fields(drops)}) f"""


FIELDS = _fields(DROPS)
LANDED = _landed(DROPS)

LINEAGE = "timestamp '2025-01-31 12:00:00' as file_modified_at, timestamp '2025-01-31 13:00:00' as loaded_at"


def _accepted(drops: str) -> str:
    return f"""
    select * from ({_landed(drops)}) l
    where digits not in (select digits from ({drops}) d where shape in ('open', 'tail'))"""


def _landed_sales(drops: str) -> str:
    return f"""
    select * exclude (digits, shape), 'inbox/sales_' || digits || '.csv' as source_filename,
           cast(strptime(digits, '%Y%m%d') as date) as batch_date, {LINEAGE}
    from ({_accepted(drops)}) a"""


def _landed_stores(good: str) -> str:
    return f"""
    select case when s_suppkey % 7 = 0 then n_name || ', Ltd' else n_name end as store_group,
           'store_' || s_suppkey as store_token,
           case when s_suppkey % 11 = 0 then null when s_suppkey % 5 = 1 then s_name || ' 5"' else s_name end as store_name,
           'inbox/stores_20250112_' || n_nationkey || '.csv' as source_filename, date '2025-01-12' as batch_date, {LINEAGE}
    from supplier join nation on s_nationkey = n_nationkey where s_suppkey % 11 = 0 or ({good})
    union all
    select 'store_group', 'store_token', 'store_name', 'inbox/stores_20250112_' || n_nationkey || '.csv',
           date '2025-01-12', timestamp '2025-01-31 12:00:00', timestamp '2025-01-31 13:00:00' from nation"""


LANDED_SALES = _landed_sales(FEW_BAD_DROPS)
# Bad store lines are those of suppliers divisible by 13 or 17 but not by 11.
LANDED_STORES = _landed_stores("s_suppkey % 13 <> 0 and s_suppkey % 17 <> 0")

CHECKED_SALES = _landed_sales(FIFTH_BAD_DROPS)
CHECKED_STORES = _landed_stores("s_suppkey % 13 <> 0")

SALES_FILES = f"""
    select digits, sum(n) as line_count, sum(bad) as bad_line_count from (
        select digits, 1 as n, case when shape in ('open', 'tail') then 1 else 0 end as bad from ({DROPS}) d
        union all
        select digits, 1, 0 from (select distinct l_shipdate, digits from ({DROPS}) d) h
        where extract(day from l_shipdate) = 1) l group by 1"""
STORE_COUNTS = f"""
    select part, count(*) as line_count,
           count(*) filter (where bad) as bad_line_count
    from ({STORE_LINES}) s group by 1"""
LOG = f"""
    select 'inbox/sales_' || digits || '.csv' as file_path, 'transactions' as file_type,
           cast(strptime(digits, '%Y%m%d') as date) as batch_date, cast(line_count as bigint) as line_count,
           cast(bad_line_count as bigint) as bad_line_count,
           case when bad_line_count > 0 then 'malformed quotes' end as error,
           case when bad_line_count > 0 then 'rejected' else 'loaded' end as status,
           cast(case when bad_line_count > 0 then 0 else line_count end as bigint) as row_count
    from ({SALES_FILES}) f
    union all
    select 'inbox/stores_20250112_' || part || '.csv', 'stores', date '2025-01-12', line_count, bad_line_count, null, 'loaded',
           line_count - bad_line_count from ({STORE_COUNTS}) s
    union all
    select 'inbox/readme_20250112_' || part || '.csv', null, date '2025-01-12', line_count, bad_line_count, 'unknown file type',
           'skipped', 0 from ({STORE_COUNTS}) s
    union all
    select 'inbox/sales_99999999_' || part || '.csv', 'transactions', null, line_count, bad_line_count,
           'no valid batch date in file name', 'rejected', 0 from ({STORE_COUNTS}) s"""

DROPPED = f"""
    select * exclude (digits, shape), case when store_token like '%1' then date '2025-01-12' else date '2025-01-11' end
           as batch_date
    from ({LANDED}) l where shape not in ('open', 'tail')"""

BASE_NAME = "regexp_extract(file_key, '([^/]*)$', 1)"
DIGITS = f"regexp_extract({BASE_NAME}, '([0-9]{{8}})', 1)"


def oracle_sql() -> dict[str, str]:
    raw_until = f"select * from ({RAW}) r where loaded_at <= timestamp '{SPLIT}'"
    target = _stage(raw_until)
    delta = _stage(f"select * from ({RAW}) r where loaded_at > (select max(loaded_at) from ({target}) t)")
    later = _stage(f"select * from ({RAW}) r where loaded_at > timestamp '{SPLIT}'")

    def daily_after(moment):
        built = _stage(f"select * from ({RAW}) r where loaded_at <= timestamp '{moment}'")
        start = f"(select max(cast(transaction_time as date)) from ({built}) b) - interval 7 day"
        return f"select * from ({DAILY}) d where transaction_date >= {start}"

    def daily_seeded(moment):
        """Day totals of the older report before the start and of all rows from it on, then the running total over both."""
        built = _stage(f"select * from ({RAW}) r where loaded_at <= timestamp '{moment}'")
        start = f"((select max(cast(transaction_time as date)) from ({built}) b) - interval 7 day)"
        older = f"""select cast(transaction_time as date) as day, sum(amount) as total from ({built}) b
            where transaction_time < {start} and transaction_time >= date_trunc('month', {start}) group by 1"""
        days = f"""select day, total from ({older}) o
            union all select transaction_date, total_amount from ({STATS}) s where transaction_date >= {start}"""
        running = f"""select day, cast(sum(total) over (partition by date_trunc('month', day) order by day) as varchar) as running
            from ({days}) x"""
        return f"""select d.* exclude (monthly_cumulative_sales), r.running as monthly_cumulative_sales
            from ({DAILY}) d join ({running}) r on d.transaction_date = r.day where d.transaction_date >= {start}"""

    def lifecycle_after(moment):
        start = f"""(select max(cast(loaded_at as date)) from ({RAW}) r
            where loaded_at <= timestamp '{moment}') - interval 3 day"""
        return f"select {AS_OF_SQL} as snapshot_date, * from ({LIFECYCLE}) l where batch_date >= {start}"

    return {
        "route_files": f"""select o_orderkey, file_key,
            case when lower({BASE_NAME}) like '%store%' then 'stores'
                 when lower({BASE_NAME}) like '%sale%' then 'transactions' end as file_type
            from ({FILE_NAMES}) f""",
        "inbox_filter": f"""select o_orderkey, file_key from ({FILE_NAMES}) f
            where file_key like '%inbox/%' and file_key not like '%/'""",
        "batch_date_extract": f"""select o_orderkey, case when {DIGITS} = '' then {AS_OF_SQL}
            else cast(try_strptime({DIGITS}, '%Y%m%d') as date) end as batch_date from ({FILE_NAMES}) f""",
        "csv_scan": f"select c1, c2, c3, c4, c5, c6, c7, shape in ('open', 'tail') as bad from ({FIELDS}) f",
        "null_tokens": f"select c2 as transaction_id, {NO_TOKEN} as receipt_token from ({FIELDS}) f",
        "sales_positional_shift": f"select transaction_id, source_id, user_role from ({LANDED}) l",
        "bad_row_policy": f"select file_path, row_count as kept_rows from ({LOG}) l where status = 'loaded'",
        "raw_sales": LANDED_SALES,
        "raw_stores": LANDED_STORES,
        "history_partitions": f"""select file_type, '2025' as year, '01' as month, '31' as day,
            count(*) as file_count, cast(sum(line_count) as bigint) as line_count
            from ({LOG}) l where status = 'loaded' group by 1""",
        "ingest_log": LOG,
        "csv_stream_ingest": DROPPED,
        "file_lineage": f"""select file_name, count(*) as row_count, count(*) as known_rows from (
            select case when store_token like '%1' then 'sales 20250112' else 'sales_20250111' end as file_name from ({DROPPED}) d
            union all select 'stores_20250112' from ({LANDED_STORES}) s) f group by 1""",
        "raw_ddl": f"""select store_token, transaction_id, receipt_token, transaction_time, amount, source_id, user_role, batch_date,
            true as has_load_time from ({RAW}) r""",
        "csv_batch_ingest": f"""select store_token, transaction_id, receipt_token, transaction_time, amount,
            source_id, user_role, batch_date, null as store_group, null as store_name from ({DROPPED}) d
            union all
            select store_token, null, null, null, null, null, null, batch_date, store_group, store_name
            from ({LANDED_STORES}) s""",
        "header_filter": f"""select store_token, transaction_id, batch_date, loaded_at from ({RAW}) r
            where store_token <> 'store_token'""",
        "amount_clean": f"""select transaction_id, amount as text,
            cast(try_cast(replace(amount, '$', '') as decimal(11,2)) as varchar) as amount from ({RAW}) r""",
        "timestamp_parse": f"""select transaction_id, transaction_time as text,
            try_strptime(transaction_time, '%Y%m%dT%H%M%S.%g') as transaction_time from ({RAW}) r""",
        "dedup_latest_sales": f"""select store_token, transaction_id, cast(amount as varchar) as amount, loaded_at
            from ({STAGE}) s""",
        "dedup_latest_stores": f"select store_token, store_name, loaded_at from ({STAGE_STORES}) s",
        "stg_sales": STAGE_PLAIN.format(STAGE),
        "stg_stores": STAGE_STORES,
        "daily_store_sales": f"""select transaction_date, store_token,
            cast(store_daily_sales as varchar) as store_daily_sales from ({STORE_DAYS}) d""",
        "daily_stats": f"""select transaction_date, active_stores, cast(total_amount as varchar) as total_amount,
            avg_store_sales from ({STATS}) s""",
        "top_store_per_day": f"select transaction_date, top_store_token as store_token from ({TOP}) t",
        "monthly_running_total": RUNNING,
        "report_daily_sales": f"{DAILY} order by s.transaction_date desc limit 40",
        "sales_left_join_stores": f"""select s.store_token, transaction_id, store_name, cast(amount as varchar) as amount
            from ({STAGE}) s left join ({STAGE_STORES}) t on s.store_token = t.store_token""",
        "top_n_dense_rank": f"""select transaction_date, store_token,
            cast(store_daily_sales as varchar) as store_daily_sales, ranking from ({RANKED}) r where ranking <= 5""",
        "last_10_dates": LAST_DATES,
        "report_top_stores": f"""select {AS_OF_SQL} as snapshot_date, transaction_date, ranking as range_top_id,
            cast(store_daily_sales as varchar) as total_sales, r.store_token, store_name
            from ({RANKED}) r left join ({STAGE_STORES}) t on r.store_token = t.store_token
            where ranking <= 5 and transaction_date in ({LAST_DATES})""",
        "lifecycle_raw_stats": RAW_STATS,
        "lifecycle_valid_stats": VALID_STATS,
        "lifecycle_full_outer": LIFECYCLE,
        "report_transactions_lifecycle": f"""select {AS_OF_SQL} as snapshot_date, * from ({LIFECYCLE}) l
            order by batch_date desc limit 40""",
        "high_water_mark": f"select max(loaded_at) as high_water from ({STAGE}) s",
        "upsert_merge": STAGE_PLAIN.format(
            f"""select * from ({target}) t where not exists (select 1 from ({later}) d
                where d.store_token = t.store_token and d.transaction_id = t.transaction_id)
            union all select * from ({later}) d"""
        ),
        "stg_sales_incremental": STAGE_PLAIN.format(delta),
        "daily_lookback": daily_after(BUILT_TO),
        "daily_lookback_seeded": daily_seeded(BUILT_TO),
        "lifecycle_lookback": lifecycle_after(BUILT_TO),
        "daily_gap_over_40_days": daily_after(GAP_FROM),
        "lifecycle_gap_over_40_days": lifecycle_after(GAP_FROM),
        "full_refresh_equivalence": STAGE_PLAIN.format(STAGE),
        "lifecycle_rollup": f"select {AS_OF_SQL} as snapshot_date, * from ({LIFECYCLE}) l",
        "stream_upsert": STAGE_PLAIN.format(STAGE),
        "stream_daily_report": DAILY,
        "stream_lifecycle_report": f"select {AS_OF_SQL} as snapshot_date, * from ({LIFECYCLE}) l",
        "dq_not_null": f"""
            select 'sales' as table_name, 'store_token' as column_name,
                   count(*) filter (where store_token is null) as failures from ({CHECKED_SALES}) s
            union all select 'sales', 'transaction_id', count(*) filter (where transaction_id is null)
                from ({CHECKED_SALES}) s
            union all select 'sales', 'receipt_token', count(*) filter (where receipt_token is null)
                from ({CHECKED_SALES}) s
            union all select 'sales', 'user_role', count(*) filter (where user_role is null)
                from ({CHECKED_SALES}) s
            union all select 'stores', 'store_token', count(*) filter (where store_token is null)
                from ({CHECKED_STORES}) s
            union all select 'stores', 'store_name', count(*) filter (where store_name is null)
                from ({CHECKED_STORES}) s""",
        "dq_unique": f"""
            select 'raw' as table_name, 'store_token' as column_name, count(*) as failures
            from (select store_token from ({RAW_STORES}) s where store_token is not null
                  group by 1 having count(*) > 1) d
            union all select 'stage', 'store_token', count(*)
            from (select store_token from ({STAGE_STORES}) s group by 1 having count(*) > 1) d""",
    }
