"""Text cleaning expressions: null tokens, money, timestamps, header rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.schemas import AMOUNT

# Texts that mean "no value" in a partner file.
NULL_TOKENS = ["NULL", "null", ""]

# The one layout partners are documented to send, and two opt-in layouts.
COMPACT = "yyyyMMdd'T'HHmmss.SSS"
ISO_SPACE = "yyyy-MM-dd HH:mm:ss"
ISO_T = "yyyy-MM-dd'T'HH:mm:ss"
DEFAULT_TIMESTAMP_FORMATS = [COMPACT]


def null_tokens(text: Column) -> Column:
    """NULL for the null tokens, the text itself otherwise."""
    return F.when(~text.isin(NULL_TOKENS), text)


def clean_amount(text: Column) -> Column:
    """Drop every dollar sign and read a decimal(11,2); NULL when that fails."""
    return F.replace(text, F.lit("$"), F.lit("")).try_cast(AMOUNT)


def _compact_to_iso(text: Column) -> Column:
    parts = [
        F.substring(text, 1, 4), F.lit("-"), F.substring(text, 5, 2), F.lit("-"), F.substring(text, 7, 2),
        F.lit(" "), F.substring(text, 10, 2), F.lit(":"), F.substring(text, 12, 2), F.lit(":"),
        F.substring(text, 14, 6),
    ]
    return F.concat(*parts)


_LAYOUTS = {
    COMPACT: (r"^[0-9]{8}T[0-9]{6}\.[0-9]{1,3}$", _compact_to_iso),
    ISO_SPACE: (r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$", lambda text: text),
    ISO_T: (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}$", lambda text: text),
}


def parse_timestamp(text: Column, formats: list[str] | None = None) -> Column:
    """Read a wall-clock timestamp in one of `formats`; NULL when none fits.

    The text is checked by a pattern and cast straight to timestamp_ntz, so no session time zone
    takes part and a time inside a daylight-saving gap stays as written.
    """
    readings = []
    for name in formats or DEFAULT_TIMESTAMP_FORMATS:
        if name not in _LAYOUTS:
            raise ValueError(f"unknown timestamp format {name!r}; known: {sorted(_LAYOUTS)}")
        pattern, to_iso = _LAYOUTS[name]
        readings.append(F.when(text.rlike(pattern), to_iso(text).try_cast("timestamp_ntz")))
    return readings[0] if len(readings) == 1 else F.coalesce(*readings)


def is_data_row(store_token: Column) -> Column:
    """False for header rows and rows without a store; compares the text as it came, untrimmed."""
    return store_token.isNotNull() & (store_token != "store_token")
