"""Column lists of the raw, stage and report layers, and typed table creation."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

AMOUNT = DecimalType(11, 2)
MONEY = DecimalType(38, 2)
MEAN = DecimalType(38, 6)

# Column names in file order. The header filter compares against the store column.
SALES_FIELDS = [
    "store_token",
    "transaction_id",
    "receipt_token",
    "transaction_time",
    "amount",
    "source_id",
    "user_role",
]
STORES_FIELDS = ["store_group", "store_token", "store_name"]


def _schema(*columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns])


_LINEAGE = [
    ("source_filename", StringType()),
    ("file_modified_at", TimestampNTZType()),
    ("batch_date", DateType()),
    ("loaded_at", TimestampNTZType()),
]

RAW_SALES = _schema(*[(name, StringType()) for name in SALES_FIELDS], *_LINEAGE)
RAW_STORES = _schema(*[(name, StringType()) for name in STORES_FIELDS], *_LINEAGE)

STAGE_SALES = _schema(
    ("store_token", StringType()),
    ("transaction_id", StringType()),
    ("receipt_token", StringType()),
    ("transaction_time", TimestampNTZType()),
    ("amount", AMOUNT),
    ("source_id", StringType()),
    ("user_role", StringType()),
    ("batch_date", DateType()),
    ("loaded_at", TimestampNTZType()),
)
STAGE_STORES = _schema(
    ("store_token", StringType()),
    ("store_group", StringType()),
    ("store_name", StringType()),
    ("batch_date", DateType()),
    ("loaded_at", TimestampNTZType()),
)

REPORT_DAILY_SALES = _schema(
    ("snapshot_date", DateType()),
    ("transaction_date", DateType()),
    ("active_stores", LongType()),
    ("total_amount", MONEY),
    ("avg_store_sales", MEAN),
    ("monthly_cumulative_sales", MONEY),
    ("top_store_token", StringType()),
)
REPORT_TOP_STORES = _schema(
    ("snapshot_date", DateType()),
    ("transaction_date", DateType()),
    ("range_top_id", IntegerType()),
    ("total_sales", MONEY),
    ("store_token", StringType()),
    ("store_name", StringType()),
)
REPORT_LIFECYCLE = _schema(
    ("snapshot_date", DateType()),
    ("batch_date", DateType()),
    ("total_raw_rows", LongType()),
    ("total_valid_rows", LongType()),
    ("total_ignored_rows", LongType()),
    ("processing_date", TimestampNTZType()),
)

RAW_LOADS = _schema(
    ("batch_date", DateType()),
    ("loaded_at", TimestampNTZType()),
    ("raw_rows", LongType()),
)

SALES_KEYS = ["store_token", "transaction_id"]
STORES_KEYS = ["store_token"]


def column_ddl(schema: StructType, defaults: dict[str, str] | None = None) -> str:
    """Column list for CREATE TABLE; `defaults` maps a column to its default expression."""
    defaults = defaults or {}
    return ", ".join(
        f"{field.name} {field.dataType.simpleString()}"
        + (f" DEFAULT {defaults[field.name]}" if field.name in defaults else "")
        for field in schema
    )


def create_raw_tables(spark: SparkSession, database: str, location: str) -> None:
    """Create the typed raw tables; a row inserted without `loaded_at` gets the load time."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    epoch = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
    load_time = {"loaded_at": f"timestampadd(MICROSECOND, unix_micros(current_timestamp()), {epoch})"}
    for name, schema in (("sales", RAW_SALES), ("stores", RAW_STORES)):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({column_ddl(schema, load_time)}) USING parquet"
        )
