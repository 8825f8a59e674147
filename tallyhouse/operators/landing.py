"""Parsing of partner CSV lines and per-file bookkeeping.

Input is a frame of lines as read by `tallyhouse.sources.lines`: `value`, `file_path`,
`file_modified_at`, `loaded_at`. Lines are split one by one, so files without a header, short rows
and rows with extra fields all load.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.cleaning import null_tokens
from tallyhouse.functions.files import STORES, TRANSACTIONS, archive_parts, batch_date, may_hold, route_file
from tallyhouse.schemas import RAW_SALES, RAW_STORES

# File states in the ingest log.
LOADED = "loaded"
REJECTED = "rejected"
SKIPPED = "skipped"

# Longest list of files that is broadcast.
BROADCAST_FILES = 10_000

# What one bad line does to its feed.
ON_ERROR = {STORES: "skip_row", TRANSACTIONS: "reject_file"}


def describe_files(files: DataFrame, run_date: dt.date | None = None) -> DataFrame:
    """Add the feed and the batch date that the file path states."""
    return files.withColumns(
        {"file_type": route_file(F.col("file_path")), "batch_date": batch_date(F.col("file_path"), run_date)}
    )


# A field in quotes, doubled inside, that ends where the field ends, or a field that does not begin with a quote.
QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
FIELD = rf'(?:{QUOTED}|(?!")[^,]*+)'
WELL_FORMED = rf"\A{FIELD}(?:,{FIELD})*+\z"
# Any field of any line: what is no whole field in quotes goes up to the next comma, its quotes being characters like others.
ANY_FIELD = rf",({QUOTED}(?=,|\z)|[^,]*+)"


def is_bad_line(value: Column) -> Column:
    """A field that begins with a quote and does not end with one: unclosed, or with text behind it.

    Inside a field that does not begin with one, a quote is a character like others. A line without quotes needs no pattern.
    """
    return value.contains('"') & ~value.rlike(WELL_FORMED)


def _unquoted(text: Column) -> Column:
    """What a field says: without its quotes and with single ones inside; NULL for nothing at all.

    A field that begins with a quote but is not whole in quotes stays as it is written.
    """
    inside = F.replace(F.substring(text, F.lit(2), F.length(text) - 2), F.lit('""'), F.lit('"'))
    whole = text.startswith('"') & text.rlike(rf"\A{QUOTED}\z")
    return F.when(whole, inside).when(text != "", text)


def field_values(value: Column) -> Column:
    """The fields between the commas outside quotes; the pattern and the unquoting are for lines with a quote only.

    Nothing at all is NULL in a line with quotes and an empty text in one without.
    """
    with_quotes = F.regexp_extract_all(F.concat(F.lit(","), value), F.lit(ANY_FIELD), F.lit(1))
    return F.when(value.contains('"'), F.transform(with_quotes, _unquoted)).otherwise(F.split(value, ","))


def split_line(value: Column, width: int) -> Column:
    """Struct c1..cN of the comma-separated fields, quotes optional, doubled inside quotes.

    Missing and empty fields are NULL, `""` is an empty text, and extra fields are left out. No character of a line is lost: an
    unclosed quote stays in its field.
    """
    fields = [F.get(field_values(value), F.lit(i)) for i in range(width)]
    return F.struct(*[F.when(value.contains('"') | (f != ""), f).alias(f"c{i + 1}") for i, f in enumerate(fields)])


def split_fields(lines: DataFrame, width: int) -> DataFrame:
    """The line frame with c1..cN in place of the text, null tokens taken out."""
    split = lines.withColumn("_fields", field_values(F.col("value")))
    cleaned = {f"c{i + 1}": null_tokens(F.get("_fields", F.lit(i))) for i in range(width)}
    return split.withColumns(cleaned).drop("_fields", "value")


def shift_roles(fields: DataFrame) -> DataFrame:
    """Set `source_id` and `user_role` from c6 and c7: a row without c7 has its role in c6."""
    return fields.withColumns(
        {
            "source_id": F.when(F.col("c7").isNotNull(), F.col("c6")),
            "user_role": F.coalesce("c7", "c6"),
        }
    )


def _raw_columns(fields: DataFrame, names: dict[str, str], schema) -> DataFrame:
    renamed = fields.withColumnsRenamed({**names, "file_path": "source_filename"})
    return renamed.select(*schema.fieldNames())


def sales_rows(lines: DataFrame) -> DataFrame:
    """Raw sales rows of lines with a batch date, six or seven fields each."""
    names = {
        "c1": "store_token",
        "c2": "transaction_id",
        "c3": "receipt_token",
        "c4": "transaction_time",
        "c5": "amount",
    }
    return _raw_columns(shift_roles(split_fields(lines, 7)), names, RAW_SALES)


def stores_rows(lines: DataFrame) -> DataFrame:
    """Raw store rows of lines with a batch date: group, token, name."""
    names = {"c1": "store_group", "c2": "store_token", "c3": "store_name"}
    return _raw_columns(split_fields(lines, 3), names, RAW_STORES)


def ingest_log(lines: DataFrame, run_date: dt.date | None = None) -> DataFrame:
    """One row per file: feed, batch date, line counts, state and the reason if it is not loaded.

    The lines of a file are counted inside each task first, so a file that holds most of them costs
    no more than the others, and the file path is read once per file and not once per line.
    """
    files = lines.groupBy("file_path", "file_modified_at").agg(
        F.count("*").alias("line_count"),
        F.count_if(is_bad_line(F.col("value"))).alias("bad_line_count"),
    )
    strict = [feed for feed, policy in ON_ERROR.items() if policy == "reject_file"]
    error = (
        F.when(F.col("file_type").isNull(), F.lit("unknown file type"))
        .when(F.col("batch_date").isNull(), F.lit("no valid batch date in file name"))
        .when(F.col("file_type").isin(strict) & (F.col("bad_line_count") > 0), F.lit("malformed quotes"))
    )
    status = (
        F.when(F.col("file_type").isNull(), F.lit(SKIPPED))
        .when(F.col("error").isNotNull(), F.lit(REJECTED))
        .otherwise(F.lit(LOADED))
    )
    good = F.col("line_count") - F.col("bad_line_count")
    return (
        describe_files(files, run_date)
        .withColumn("error", error)
        .withColumns(
            {"status": status, "row_count": F.when(F.col("error").isNull(), good).otherwise(F.lit(0))}
        )
    )


def file_counts(log: DataFrame) -> DataFrame:
    """Number of files and rows per feed and state."""
    return log.groupBy("file_type", "status").agg(
        F.count("*").alias("file_count"), F.sum("row_count").alias("row_count")
    )


def _loaded(log: DataFrame, max_files: int | None) -> DataFrame:
    """The loaded files with what the log says of them.

    They are broadcast if `max_files` states a small bound for the files of this batch; otherwise
    Spark picks the join by measured size.
    """
    files = log.filter(F.col("status") == LOADED).select("file_path", "file_type", "batch_date")
    return F.broadcast(files) if max_files is not None and max_files <= BROADCAST_FILES else files


def good_lines(lines: DataFrame, log: DataFrame, feed: str, max_files: int | None = None) -> DataFrame:
    """Lines of one feed that load, with their batch date.

    Files that are not loaded are left out whole, and so are bad lines. The first filter decides by
    the file path alone, so Spark does not open files of the other feed; the log has the last word.
    """
    near = lines.filter(may_hold(F.col("file_path"), feed))
    kept = near.filter(~is_bad_line(F.col("value")))
    return kept.join(_loaded(log, max_files).filter(F.col("file_type") == feed), "file_path")


def archive_rows(
    lines: DataFrame, log: DataFrame, processed_at: Column, max_files: int | None = None
) -> DataFrame:
    """Every line of the loaded files with the archive folder columns."""
    archived = lines.join(_loaded(log, max_files), "file_path")
    return archived.withColumns(archive_parts(processed_at)).select(
        "value", "file_path", "file_type", "year", "month", "day"
    )
