"""Keep the latest version of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_first(df: DataFrame, keys: list[str], lead: str = "loaded_at") -> list[Column]:
    """A total order, newest first.

    Rows of one load share the load time, so the file time, the file name and then every other
    column settle ties; two rows that still tie are equal.
    """
    known = set(df.columns) - set(keys) - {lead}
    rest = [name for name in ("file_modified_at", "source_filename") if name in known]
    rest += [name for name in df.columns if name in known and name not in rest]
    return [F.desc_nulls_first(lead)] + [F.desc_nulls_last(name) for name in rest]


def keep_latest(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row per key, the first in `order`.

    The rank filter lets Spark cut every key to one row inside each map task before the shuffle,
    so a key that holds a large share of the input sends one row per task. The hash leads the sort:
    one long settles nearly every comparison that two text keys would need.
    """
    window = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*(order or latest_first(df, keys)))
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def newest_by_aggregate(df: DataFrame, keys: list[str], lead: str = "loaded_at") -> DataFrame:
    """One row per key, the first by `latest_first`, as an aggregation.

    Over a stream this is state that Spark keeps: a row per key, and each batch gives the keys it brought rows for. The order is
    that of `latest_first`: a missing lead is the newest, missing values are the oldest elsewhere.
    """
    known = [name for name in df.columns if name not in (*keys, lead)]
    rest = [name for name in ("file_modified_at", "source_filename") if name in known]
    rest += [name for name in known if name not in rest]
    order = F.struct(F.col(lead).isNull().alias("unknown"), F.col(lead), *rest)
    newest = df.groupBy(*keys).agg(F.max(order).alias("newest"))
    return newest.select(*[name if name in keys else F.col(f"newest.{name}").alias(name) for name in df.columns])
