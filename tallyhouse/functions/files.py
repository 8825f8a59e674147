"""Expressions over file names: inbox test, routing, batch date, archive folder."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The feeds and the word in the file name that marks each.
STORES = "stores"
TRANSACTIONS = "transactions"
FEED_WORDS = {STORES: "store", TRANSACTIONS: "sale"}


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def in_inbox(key: Column) -> Column:
    """A file somewhere below a folder named inbox; folder markers end with a slash."""
    return key.contains("inbox/") & ~key.endswith("/")


def route_file(path: Column) -> Column:
    """Feed of a file by its base name; the store rule goes first. NULL when no rule fits."""
    return F.when(may_hold(path, STORES), F.lit(STORES)).when(may_hold(path, TRANSACTIONS), F.lit(TRANSACTIONS))


def may_hold(path: Column, feed: str) -> Column:
    """Whether the base name has the word of a feed: true for all its files and maybe for others."""
    return F.lower(base_name(path)).contains(FEED_WORDS[feed])


def batch_date(path: Column, run_date: dt.date | None = None) -> Column:
    """Date from the first eight digits of the base name, the run date if there are none.

    Eight digits that are no date give NULL, and landing rejects that file.
    """
    digits = F.regexp_extract(base_name(path), r"([0-9]{8})", 1)
    fallback = F.lit(run_date) if run_date else F.current_date()
    return F.when(digits == "", fallback).otherwise(F.try_to_date(digits, "yyyyMMdd"))


def archive_parts(processed_at: Column) -> dict[str, Column]:
    """Archive folder columns, taken from the processing time."""
    return {
        "year": F.date_format(processed_at, "yyyy"),
        "month": F.date_format(processed_at, "MM"),
        "day": F.date_format(processed_at, "dd"),
    }
