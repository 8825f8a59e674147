"""Text line sources with file lineage, as a batch or as a stream."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.functions.clock import clock_literal, utc_clock
from tallyhouse.operators.landing import FIELD


def _with_lineage(text: DataFrame, loaded_at: dt.datetime | None, *others: str) -> DataFrame:
    now = clock_literal(loaded_at) if loaded_at else utc_clock(F.current_timestamp())
    return text.select(
        "value",
        _plain_path(F.col("_metadata.file_path")).alias("file_path"),
        utc_clock(F.col("_metadata.file_modification_time")).alias("file_modified_at"),
        now.alias("loaded_at"),
        *others,
    )


def _plain_path(path: Column) -> Column:
    """The name as it is in the folder; the lineage column writes blanks and other characters as %20 and the like."""
    decoded = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(path.contains("%"), F.coalesce(decoded, path)).otherwise(path)


def exact_path(path: str) -> str:
    """A path that a reader takes for itself and not for a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def list_files(spark: SparkSession, inbox: str) -> DataFrame:
    """Files below the inbox: `path`, `length`, `file_modified_at`. File contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(inbox)
        .select("path", "length", utc_clock(F.col("modificationTime")).alias("file_modified_at"))
    )


def read_lines(
    spark: SparkSession, paths: str | list[str], loaded_at: dt.datetime | None = None
) -> DataFrame:
    """All lines of the given files or folders, header lines included."""
    text = spark.read.option("recursiveFileLookup", "true").text(paths)
    return _with_lineage(text, loaded_at)


def stream_files(spark: SparkSession, inbox: str, max_files: int = 1000, **options: str) -> DataFrame:
    """Files as they arrive: `path` and `loaded_at`. Their contents are not read, and one that has gone meanwhile is not there.

    The load time is fixed before the sink, so a batch that is replayed after a failure gets the
    same value. `options` go to the file source, such as `cleanSource` and `sourceArchiveDir`.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", "true")
        .option("ignoreMissingFiles", "true")
        .option("maxFilesPerTrigger", max_files)
        .options(**options)
        .load(inbox)
    )
    return files.select("path", utc_clock(F.current_timestamp()).alias("loaded_at"))


# The rest of a quoted field that an earlier line opened, and what a line may be to it.
_INNER = r'[^"]*+(?:""[^"]*+)*+'
_STAYS = rf"\A{_INNER}\z"
_CLOSES = rf'\A{_INNER}"(?:,{FIELD})*+\z'
_REOPENS = rf'\A{_INNER}"(?:,{FIELD})*+,"{_INNER}\z'
_OPENS = rf'\A(?:{FIELD},)*+"{_INNER}\z'


def _with_quote_steps(lines: DataFrame) -> DataFrame:
    """What each line makes of the two states that it can begin in, outside quotes (`from_out`) and inside (`from_in`), as 0 or 1.

    A line that cannot go on inside, as it closes the quote and goes on with something else than a comma, begins anew: the open quote
    before it was a character like others.
    """
    value, quotes = F.col("value"), F.col("value").contains('"')
    opens = F.when(quotes, value.rlike(_OPENS)).otherwise(False)
    closes = F.when(quotes, value.rlike(_CLOSES)).otherwise(False)
    stays = F.when(quotes, value.rlike(_STAYS) | value.rlike(_REOPENS)).otherwise(True)
    return lines.withColumns({"opens": opens.cast("int"), "closes": closes, "stays": stays}).withColumns(
        {"from_out": F.col("opens"), "from_in": F.when(F.col("closes"), 0).when(F.col("stays"), 1).otherwise(F.col("opens"))}
    )


def _states(rows: DataFrame, group: list[str], order: str) -> DataFrame:
    """`fixed` and `turned`: the state behind each row, if any row of its group up to it settles the state, else whether it is turned round.

    A step is one of four: to outside, to inside, as before, or the other way round. The last step that settles the state and the number of
    turns since then say all, so it is two running aggregates.
    """
    running = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    settles = F.col("from_out") == F.col("from_in")
    turns = F.sum(F.when(~settles & (F.col("from_out") == 1), 1).otherwise(0)).over(running)
    settled = F.when(settles, F.struct(F.col("from_out").alias("state"), F.col("turns")))
    last = F.last(settled, ignorenulls=True).over(running)
    rows = rows.withColumn("turns", turns).withColumn("last", last)
    return rows.withColumns(
        {"fixed": (F.col("last.state") + F.col("turns") - F.col("last.turns")) % 2, "turned": F.col("turns") % 2}
    ).drop("turns", "last")


def _begin_states(lines: DataFrame, split: list[str]) -> DataFrame:
    """Per split: the state that its first line begins in; one row per split, ordered within its file."""
    ends = lines.groupBy(*split).agg(F.max_by(F.struct("fixed", "turned"), "place").alias("end"))
    steps = ends.withColumns(
        {"from_out": F.coalesce("end.fixed", "end.turned"), "from_in": F.coalesce(F.col("end.fixed"), 1 - F.col("end.turned"))}
    )
    behind = _states(steps, ["file_path"], "block")
    before = Window.partitionBy("file_path").orderBy("block")
    state = F.lag(F.coalesce("fixed", "turned")).over(before)
    return behind.select(*split, F.coalesce(state, F.lit(0)).alias("begin"))


def read_multiline(spark: SparkSession, paths: str | list[str], loaded_at: dt.datetime | None = None) -> DataFrame:
    """Records of files whose quoted fields may hold line breaks, in the columns of `read_lines`.

    Files are split over tasks like others. What each line does to the state of the quotes is composed within its split and then over the splits
    of its file, which tells for every line whether it begins a record or goes on with one; only lines of records of several lines are
    brought together. A quote that is never closed, or closed before something else than a comma, is a character like others, and its
    lines are records of their own. Empty lines outside records are passed over.
    """
    text = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(paths)
    placed = text.select("value", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"), "_metadata")
    lines = _with_lineage(placed, loaded_at, "block", "place")
    lines = _with_quote_steps(lines.withColumn("value", F.regexp_replace("value", "\r\\z", "")))

    split = ["file_path", "block"]
    lines = _states(lines, split, "place")
    lines = lines.join(_begin_states(lines, split), split)
    here = Window.partitionBy(*split).orderBy("place")
    behind = F.coalesce("fixed", (F.col("begin") + F.col("turned")) % 2)
    lines = lines.withColumn("behind", behind).withColumn("state", F.coalesce(F.lag("behind").over(here), F.col("begin")))
    goes_on = (F.col("state") == 1) & (F.col("closes") | F.col("stays"))
    lines = lines.withColumns({"goes_on": goes_on, "several": goes_on | (F.col("behind") == 1)})

    # A record is named by the place of its first line among the first lines of its file: counted in the split, and before it.
    first = F.when(F.col("goes_on"), 0).otherwise(1)
    lines = lines.withColumn("count", F.sum(first).over(here.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    counts = lines.groupBy(*split).agg(F.max("count").alias("held"))
    earlier = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*split, F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
    lines = lines.join(counts, split).withColumn("record", F.col("before") + F.col("count"))

    several = lines.where("several")
    record = ["file_path", "record"]
    closed = several.groupBy(*record).agg(F.max((F.col("goes_on") & F.col("closes")).cast("int")).alias("closed"))
    several = several.join(closed, record)
    parts = F.array_sort(F.collect_list(F.struct("block", "place", "value")))
    joined = several.where("closed = 1").groupBy(*record, "file_modified_at", "loaded_at").agg(parts.alias("parts"))
    joined = joined.withColumn("value", F.array_join("parts.value", "\n"))
    columns = ["value", "file_path", "file_modified_at", "loaded_at"]
    single = lines.where("NOT several").select(*columns).unionByName(several.where("closed = 0").select(*columns))
    return single.where(F.col("value") != "").unionByName(joined.select(*columns))
