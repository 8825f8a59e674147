"""Landing of file batches into the raw tables."""

from __future__ import annotations

import datetime as dt
import itertools
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tallyhouse.functions.clock import utc_now
from tallyhouse.functions.files import STORES, TRANSACTIONS, in_inbox
from tallyhouse.operators.landing import (
    BROADCAST_FILES,
    LOADED,
    REJECTED,
    archive_rows,
    describe_files,
    good_lines,
    ingest_log,
    sales_rows,
    stores_rows,
)
from tallyhouse.operators.quality import NOT_NULL, NULL_COUNTS, counted_on_the_way, null_counts
from tallyhouse.session import delete_matching, move_path, path_exists
from tallyhouse.sources.lines import exact_path, list_files, read_lines, read_multiline
from tallyhouse.sources.raw import append_batch, append_raw

# Files per landing batch; it bounds what a batch broadcasts.
MAX_FILES = BROADCAST_FILES

# Counts of rows and NULLs per batch, below the root.
RAW_CHECKS = "raw_checks"

# Files that are moved at a time.
MOVES = 16

# Times that a listing starts anew because a file went meanwhile.
LISTINGS = 5

# What Spark says of a file that has gone or cannot be read.
UNREADABLE = ("FAILED_READ_FILE", "PATH_NOT_FOUND", "FileNotFoundException", "ZipException", "EOFException")

INGEST_LOG = StructType(
    [
        StructField("file_path", StringType()),
        StructField("file_modified_at", TimestampNTZType()),
        StructField("file_type", StringType()),
        StructField("batch_date", DateType()),
        StructField("line_count", LongType()),
        StructField("bad_line_count", LongType()),
        StructField("error", StringType()),
        StructField("status", StringType()),
        StructField("row_count", LongType()),
        StructField("ingest_batch", StringType()),
    ]
)
LEDGER = StructType(
    [
        StructField("path", StringType()),
        StructField("length", LongType()),
        StructField("file_modified_at", TimestampNTZType()),
        StructField("loaded_at", TimestampNTZType()),
        StructField("state", StringType()),
        StructField("ingest_batch", StringType()),
    ]
)


class RejectedFiles(Exception):
    """Some files of a strict landing were rejected; all others have landed."""


def check_inbox(inbox: str) -> str:
    """The folder itself, if its files pass the inbox test; a folder named otherwise would land nothing."""
    if "inbox/" not in f"{inbox.rstrip('/')}/":
        raise ValueError(f"the path of an inbox has a folder named inbox, unlike {inbox!r}")
    return inbox


def land(
    lines: DataFrame,
    root: str,
    ingest_batch: str,
    run_date: dt.date | None = None,
    archive: bool = False,
    max_files: int | None = None,
) -> DataFrame:
    """Write one batch of lines to the raw tables below `root` and return its ingest log.

    One bad file does not stop the others. Every write replaces what an earlier try of the same
    batch left behind. The log is written first and read back, so the files to turn away are known
    before any of their rows land. Rows and NULLs are counted by the job that writes them. `max_files` states a bound for the files of this batch, if any.
    """
    spark = lines.sparkSession
    lines = lines.filter(in_inbox(F.col("file_path")))
    append_batch(ingest_log(lines, run_date), f"{root}/ingest_log", ingest_batch, [])
    log_path = f"{root}/ingest_log/ingest_batch={ingest_batch}"
    if not path_exists(spark, log_path):
        return spark.createDataFrame([], INGEST_LOG)
    own = StructType(INGEST_LOG.fields[:-1])
    log = spark.read.schema(own).parquet(log_path).withColumn("ingest_batch", F.lit(ingest_batch))
    feeds = {row[0] for row in log.filter(F.col("status") == LOADED).select("file_type").distinct().collect()}
    counts: list[tuple] = []
    for feed, table, rows in (
        (TRANSACTIONS, "sales", sales_rows),
        (STORES, "stores", stores_rows),
    ):
        if feed in feeds:
            accepted, seen = counted_on_the_way(rows(good_lines(lines, log, feed, max_files)), NOT_NULL[table])
            append_raw(accepted, f"{root}/raw/{table}", ingest_batch)
            counts += null_counts(seen, table, NOT_NULL[table])
    if counts:
        append_batch(spark.createDataFrame(counts, NULL_COUNTS).coalesce(1), f"{root}/{RAW_CHECKS}", ingest_batch, [])
    if archive and feeds:
        kept = archive_rows(lines, log, F.col("loaded_at"), max_files)
        append_batch(kept, f"{root}/history", ingest_batch, ["file_type", "year", "month", "day"])
    return log


def read_null_counts(spark: SparkSession, root: str) -> DataFrame | None:
    """Rows and NULLs per checked column of the raw tables, as counted when they were written; None if nothing was counted."""
    if not path_exists(spark, f"{root}/{RAW_CHECKS}"):
        return None
    counts = spark.read.schema(NULL_COUNTS).parquet(f"{root}/{RAW_CHECKS}")
    return counts.groupBy("table_name", "column_name").agg(F.sum("row_count").alias("row_count"), F.sum("failures").alias("failures"))


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/ledger"
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def new_files(listing: DataFrame, root: str) -> DataFrame:
    """Listed files that no batch has taken: new names, and known names with changed content."""
    known = read_ledger(listing.sparkSession, root).select("path", "length", "file_modified_at")
    return listing.join(known, ["path", "length", "file_modified_at"], "left_anti")


def land_files(
    spark: SparkSession,
    inbox: str,
    root: str,
    run_date: dt.date | None = None,
    archive: bool = False,
    max_files: int = MAX_FILES,
    strict: bool = False,
    move_to: str | None = None,
    multiline: bool = False,
) -> list[str]:
    """Land everything new in the inbox, in batches of at most `max_files`, and name the batches.

    The inbox is listed once. The file list and the load time of a batch are noted before it starts and marked done after,
    so a run that dies is taken up by the next one with the same files and the same load time.
    A file that has gone or cannot be read is turned away in the log, and the others of its batch land without it.
    `strict` raises once all batches are through if a file was rejected. `move_to` is a folder on the same file
    system that landed files are moved to as they are, by feed, load day and batch; `restore_files` brings them back.
    `multiline` reads files whose quoted fields may hold line breaks.
    """
    check_inbox(inbox)
    _plan_new(spark, inbox, root, max_files)
    read = read_multiline if multiline else read_lines
    landed = []
    for ingest_batch, loaded_at in _open_batches(spark, root):
        planned = read_ledger(spark, root).filter(
            (F.col("ingest_batch") == ingest_batch) & (F.col("state") == "planned")
        )
        paths = sorted({row.path for row in planned.select("path").collect()})
        here = [path for path in paths if path_exists(spark, path)]
        gone = sorted(set(paths) - set(here))
        _turn_away(spark, root, gone, "missing", f"{ingest_batch}-missing", run_date)

        def land_paths(paths: list[str], label: str) -> None:
            lines = read(spark, [exact_path(path) for path in paths], loaded_at)  # noqa: B023
            land(lines, root, label, run_date, archive, max_files)

        land_readable(spark, root, here, ingest_batch, land_paths, run_date)
        _note(spark, root, [(None, None, None, loaded_at, "done", ingest_batch)])
        if move_to is not None:
            _move_landed(spark, root, ingest_batch, loaded_at, move_to)
        landed.append(ingest_batch)
    if strict:
        _raise_rejected(spark, root, landed)
    return landed


def _is_unreadable(error: Exception) -> bool:
    return any(sign in str(error) for sign in UNREADABLE)


def forget_batch(spark: SparkSession, root: str, label: str) -> None:
    """Delete what a try of a batch has left behind."""
    for table in ("ingest_log", RAW_CHECKS, "raw/sales/*", "raw/stores/*", "history/*/*/*/*"):
        delete_matching(spark, root, f"{table}/ingest_batch={label}")


def land_readable(
    spark: SparkSession,
    root: str,
    paths: list[str],
    label: str,
    land_paths: Callable[[list[str], str], None],
    run_date: dt.date | None,
) -> None:
    """Land the files together; if one cannot be read, halve the list until it stands alone."""
    if not paths:
        return
    try:
        land_paths(paths, label)
        return
    except Exception as error:
        if not _is_unreadable(error):
            raise
    forget_batch(spark, root, label)
    if len(paths) == 1:
        reason = "unreadable" if path_exists(spark, paths[0]) else "missing"
        _turn_away(spark, root, paths, reason, label, run_date)
        return
    half = len(paths) // 2
    land_readable(spark, root, paths[:half], f"{label}-0", land_paths, run_date)
    land_readable(spark, root, paths[half:], f"{label}-1", land_paths, run_date)


def _turn_away(
    spark: SparkSession, root: str, paths: list[str], reason: str, label: str, run_date: dt.date | None
) -> None:
    """Log files none of whose lines could be read."""
    if not paths:
        return
    files = describe_files(spark.createDataFrame([(path,) for path in paths], "file_path string"), run_date)
    none = F.lit(0).cast("long")
    values = {
        "file_modified_at": F.lit(None).cast("timestamp_ntz"),
        "line_count": none,
        "bad_line_count": none,
        "error": F.lit(reason),
        "status": F.lit(REJECTED),
        "row_count": none,
    }
    log = files.withColumns(values).select(*INGEST_LOG.fieldNames()[:-1])
    append_batch(log, f"{root}/ingest_log", label, [])


def _batch_log(spark: SparkSession, root: str, batches: list[str]) -> DataFrame:
    """The log of some batches and of the parts they were halved into."""
    log = spark.read.schema(INGEST_LOG).parquet(f"{root}/ingest_log")
    return log.filter(F.substring_index("ingest_batch", "-", 2).isin(batches))


def _move_all(spark: SparkSession, moves: list[tuple[str, str]]) -> None:
    """Rename files, several at a time, as each is one call to the file system."""
    with ThreadPoolExecutor(MOVES) as pool:
        list(pool.map(lambda names: move_path(spark, *names), moves))


def _move_landed(spark: SparkSession, root: str, ingest_batch: str, loaded_at: dt.datetime, folder: str) -> None:
    """Move the landed files of a batch, at most as many as a batch has, out of the inbox to the folders of their feed and load day."""
    if not path_exists(spark, f"{root}/ingest_log"):
        return
    landed = _batch_log(spark, root, [ingest_batch]).filter(F.col("status") == LOADED)
    rows = landed.select("file_path", "file_type").distinct().collect()
    day = loaded_at.strftime("year=%Y/month=%m/day=%d")
    names = [(row.file_path, f"{row.file_type}/{day}/{ingest_batch}/{row.file_path.rpartition('inbox/')[2]}") for row in rows]
    _move_all(spark, [(old, f"{folder}/{new}") for old, new in names])


def restore_files(spark: SparkSession, folder: str, inbox: str, feed: str, day: dt.date) -> int:
    """Move the files of a feed that landed on a day back below an inbox, byte by byte what they were; returns their number.

    Files that came under one name in several batches go to a folder for each batch but the first.
    """
    source = f"{folder}/{feed}/{day:year=%Y/month=%m/day=%d}"
    if not path_exists(spark, source):
        return 0
    taken: set[str] = set()
    moves = []
    for (path,) in list_files(spark, source).select("path").orderBy("path").toLocalIterator():
        batch, _, name = path.rpartition(f"{day:day=%d}/")[2].partition("/")
        moves.append((path, f"{inbox}/{f'{batch}/' if name in taken else ''}{name}"))
        taken.add(name)
    _move_all(spark, moves)
    return len(moves)


def _raise_rejected(spark: SparkSession, root: str, batches: list[str]) -> None:
    if not batches or not path_exists(spark, f"{root}/ingest_log"):
        return
    rejected = _batch_log(spark, root, batches).filter(F.col("status") == REJECTED)
    count = rejected.count()
    if count:
        some = "; ".join(f"{r.file_path}: {r.error}" for r in rejected.orderBy("file_path").limit(20).collect())
        raise RejectedFiles(f"{count} files rejected, all in the ingest log, the first 20 here: {some}")


def _note(spark: SparkSession, root: str, rows: list[tuple]) -> None:
    entry = spark.createDataFrame(rows, LEDGER).coalesce(1)
    entry.write.mode("append").parquet(f"{root}/ledger")


def _open_batches(spark: SparkSession, root: str) -> list[tuple[str, dt.datetime]]:
    """Batches that were planned and not finished, in the order of their load times."""
    ledger = read_ledger(spark, root)
    done = ledger.filter("state = 'done'").select("ingest_batch")
    rows = ledger.filter("state = 'planned'").join(done, "ingest_batch", "left_anti")
    return [tuple(r) for r in rows.select("ingest_batch", "loaded_at").distinct().orderBy("loaded_at", "ingest_batch").collect()]


def _plan_new(spark: SparkSession, inbox: str, root: str, max_files: int) -> None:
    """Plan all new files of one listing; a file that goes while it is listed makes it start anew."""
    for attempt in itertools.count():
        try:
            return _plan_batches(list_files(spark, inbox), root, max_files)
        except Exception as error:
            if attempt == LISTINGS or not _is_unreadable(error):
                raise


def _plan_batches(listing: DataFrame, root: str, max_files: int) -> None:
    """Note all new files as batches, the oldest first; a batch at a time passes through the driver.

    Load times grow from batch to batch and never fall behind an earlier run's, whatever the clock says.
    """
    spark = listing.sparkSession
    newest = read_ledger(spark, root).agg(F.max("loaded_at")).first()[0]
    found = new_files(listing, root).orderBy("file_modified_at", "path").toLocalIterator()
    run, tick = uuid.uuid4().hex, dt.timedelta(microseconds=1)
    for k in itertools.count():
        files = list(itertools.islice(found, max_files))
        if not files:
            return
        now = utc_now()
        newest = now if newest is None else max(now, newest + tick)
        label = f"{run}-{k:06d}"
        _note(spark, root, [(f.path, f.length, f.file_modified_at, newest, "planned", label) for f in files])
