"""Wall-clock timestamps that no session or driver time zone can shift."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def clock_literal(value: dt.datetime | dt.date | str) -> Column:
    """The value as a timestamp without zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


def utc_clock(instant: Column) -> Column:
    """The UTC wall-clock time of an instant: it never runs backwards, as a local clock may."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), clock_literal("1970-01-01 00:00:00"))


def utc_now() -> dt.datetime:
    """The driver's UTC wall-clock time."""
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
