"""Stage tables: cleaned, typed, one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.cleaning import clean_amount, is_data_row, parse_timestamp
from tallyhouse.operators.dedup import keep_latest
from tallyhouse.schemas import SALES_KEYS, STAGE_SALES, STAGE_STORES, STORES_KEYS

LINEAGE = ("source_filename", "file_modified_at", "batch_date", "loaded_at")


def drop_headers(raw: DataFrame) -> DataFrame:
    """Rows of real data: no header lines, no rows without a store."""
    return raw.filter(is_data_row(F.col("store_token")))


def _lineage(raw: DataFrame) -> list[str]:
    return [name for name in LINEAGE if name in raw.columns]


def clean_sales(raw: DataFrame, timestamp_formats: list[str] | None = None) -> DataFrame:
    """Raw sales without headers, trimmed and typed."""
    return drop_headers(raw).select(
        F.trim("store_token").alias("store_token"),
        F.trim("transaction_id").alias("transaction_id"),
        F.trim("receipt_token").alias("receipt_token"),
        parse_timestamp(F.col("transaction_time"), timestamp_formats).alias("transaction_time"),
        clean_amount(F.col("amount")).alias("amount"),
        F.trim("source_id").alias("source_id"),
        F.trim("user_role").alias("user_role"),
        *_lineage(raw),
    )


def clean_stores(raw: DataFrame) -> DataFrame:
    """Raw stores without headers, trimmed."""
    return drop_headers(raw).select(
        F.trim("store_token").alias("store_token"),
        F.trim("store_group").alias("store_group"),
        F.trim("store_name").alias("store_name"),
        *_lineage(raw),
    )


def sales_versions(raw: DataFrame, timestamp_formats: list[str] | None = None) -> DataFrame:
    """Every version of every transaction, with the lineage that settles ties and the columns of the stage in their order."""
    cleaned = clean_sales(raw, timestamp_formats)
    rest = [name for name in cleaned.columns if name not in STAGE_SALES.fieldNames()]
    return cleaned.select(*STAGE_SALES.fieldNames(), *rest)


def stage_sales(raw: DataFrame, timestamp_formats: list[str] | None = None) -> DataFrame:
    """Newest version of every transaction."""
    latest = keep_latest(clean_sales(raw, timestamp_formats), SALES_KEYS)
    return latest.select(*STAGE_SALES.fieldNames())


def stage_stores(raw: DataFrame) -> DataFrame:
    """Newest version of every store."""
    return keep_latest(clean_stores(raw), STORES_KEYS).select(*STAGE_STORES.fieldNames())
