from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import at, tuples
from tallyhouse.functions.cleaning import (
    COMPACT,
    ISO_SPACE,
    ISO_T,
    clean_amount,
    is_data_row,
    null_tokens,
    parse_timestamp,
)


def apply(spark, texts, function):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("t"))).collect()]


def test_null_tokens(spark):
    assert apply(spark, ["NULL", "null", "", "Null", " ", "x", None], null_tokens) == [
        None, None, None, "Null", " ", "x", None,
    ]


def test_amount(spark):
    texts = ["$150.505", "-$5.005", "9999999999.99", "N/A", None, "$1,234.50", "$$7", "1e3", "999999999.99"]
    expected = ["150.51", "-5.01", None, None, None, None, "7.00", "1000.00", "999999999.99"]
    assert apply(spark, texts, clean_amount) == [None if e is None else Decimal(e) for e in expected]


def test_timestamp_default_layout(spark):
    texts = [
        "20211001T174600.000", "20211001T174600.1", "20211001T174600", "20211301T174600.000", "20210230T000000.000",
        "20211001T240000.000", "2021-10-01 17:46:00", "20211001T174600.0001", "x20211001T174600.000", None,
    ]
    whole = at("2021-10-01 17:46:00")
    tenth = at("2021-10-01 17:46:00.100")
    assert apply(spark, texts, parse_timestamp) == [whole, tenth] + [None] * 8


def test_timestamp_opt_in_layouts(spark):
    texts = ["2021-10-01 17:46:00", "2021-10-01T17:46:00", "20211001T174600.000", "2021-10-01"]
    both = apply(spark, texts, lambda c: parse_timestamp(c, [COMPACT, ISO_SPACE, ISO_T]))
    assert both == [at("2021-10-01 17:46:00")] * 3 + [None]
    assert apply(spark, texts, lambda c: parse_timestamp(c, [ISO_T]))[:2] == [None, at("2021-10-01 17:46:00")]
    with pytest.raises(ValueError):
        parse_timestamp(F.col("t"), ["dd/MM/yyyy"])


def test_timestamp_in_daylight_saving_gap_stays_as_written(spark, zone):
    zone("America/New_York")
    assert apply(spark, ["20210314T023000.000"], parse_timestamp) == [at("2021-03-14 02:30:00")]


def test_header_filter_compares_untrimmed_text(spark):
    df = spark.createDataFrame([("store_token",), (" store_token",), ("STORE_TOKEN",), (None,), ("",)], "t string")
    assert sorted(tuples(df.filter(is_data_row(F.col("t"))))) == [("",), (" store_token",), ("STORE_TOKEN",)]
