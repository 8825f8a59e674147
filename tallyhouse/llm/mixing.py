"""Mixing sources to target weights by pivotal dependent rounding.

A source that shall give r times its words gives each document floor(r) times, and once more with a
probability of r - floor(r). These probabilities are rounded two at a time: words move from one document to the other until
one of the two is at 0 or 1, the direction drawn so that each keeps its expectation. The words
expected of the pair never change, so a source ends within a document of its target.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.scratch import Scratch

WEIGHTS = (3.0, 1.0, 2.0)
#: Documents rounded in one group, and groups whose residuals meet in the next.
LEAF, FANOUT = 20_000, 16
#: Equal rows that one group takes, about.
SHARE = 5_000
#: Documents of each power of two of sizes that a group passes on unrounded, to settle the last residual with.
RESERVE = 2
_EDGE = 1e-12
_ROWS = "doc_id long, source string, size long, source_size long, target double, whole long, share double, key long, extra int, node long"


def source_targets(sizes: DataFrame, total_share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target): words each source shall give.

    `sizes` has one row per source (null is a source) with source_size. Sources ordered by code point,
    null last, get the weights in turn and share total_share of all words; no target exceeds `most` times
    the source's size, and what it cannot take is shared by the others by weight until none is above. That is
    the level at which the capped shares sum up: sources are capped in order of capacity per weight.
    """
    n = len(weights)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighted = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place % n + 1).cast("int")))
    weighted = weighted.withColumn("cap", most * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    upto = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    spare = total_share * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))
    left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0))
    level = weighted.withColumn("level", spare / left)
    # The first source whose capacity lies above the level of those not yet capped sets the level.
    first = F.min(F.when(F.col("level") < F.col("ratio"), F.struct("ratio", (-F.col("level")).alias("under")))).over(whole)
    level = level.withColumn("level", -first["under"])
    target = F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return level.select("source", "source_size", target.alias("target"))


def pivot(sizes: np.ndarray, shares: np.ndarray, rng: np.random.Generator) -> int:
    """Round `shares` in place, in the given order; returns the row that may stay open, or -1."""
    draws = rng.random(len(sizes))
    held = -1
    for k in range(len(sizes)):
        if held < 0:
            held = k
            continue
        a, b = sizes[held], sizes[k]
        up = min((1 - shares[held]) * a, shares[k] * b)  # words that can move to the held row
        down = min(shares[held] * a, (1 - shares[k]) * b)
        if draws[k] * (up + down) < down:
            shares[held] += up / a
            shares[k] -= up / b
        else:
            shares[held] -= down / a
            shares[k] += down / b
        for row in (held, k):
            if shares[row] < _EDGE or shares[row] > 1 - _EDGE:
                shares[row] = round(shares[row])
        open_rows = [row for row in (held, k) if 0 < shares[row] < 1]
        held = open_rows[0] if open_rows else -1
    return held


def _settle(sizes: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """The last residuals of a source, largest first, each to the side that keeps the words nearest to what is expected."""
    debt, out = 0.0, np.zeros(len(sizes), dtype=np.int32)
    for k, (size, share) in enumerate(zip(sizes, shares, strict=True)):
        debt += share * size
        out[k] = debt >= size / 2
        debt -= out[k] * size
    return out


def _round_group(rows: pa.Table, level: int, last: bool) -> pa.Table:
    """Round the rows of one group, per source; rows that stay open have extra -1."""
    names = rows.column("source").to_pylist()
    code = {name: k for k, name in enumerate(dict.fromkeys(names))}
    source = np.array([code[x] for x in names])
    size, share, key = (rows.column(c).to_numpy() for c in ("size", "share", "key"))
    # The order, and with it every draw, follows from the rows alone.
    order = np.lexsort((share, key, -size, source))
    share, extra = share.copy(), np.full(len(size), -1, dtype=np.int32)
    for name, k in code.items():
        own = order[source[order] == k]
        if last:
            extra[own] = _settle(size[own], share[own])
            continue
        kind = np.floor(np.log2(size[own])).astype(int)  # falls along the order
        rank = np.arange(len(own)) - np.searchsorted(-kind, -kind)
        rest = own[rank >= RESERVE]
        seed = [level, int(rows.column("node")[0].as_py()), zlib.crc32(repr(name).encode("utf-8", "surrogatepass"))]
        rounded = share[rest]
        held = pivot(size[rest], rounded, np.random.default_rng(seed))
        share[rest] = rounded
        extra[rest] = np.rint(rounded).astype(np.int32)
        if held >= 0:
            extra[rest[held]] = -1
    out = rows.set_column(rows.schema.get_field_index("share"), "share", pa.array(share))
    return out.set_column(out.schema.get_field_index("extra"), "extra", pa.array(extra))


def mix_sources(documents: DataFrame, total_share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """How many words of each document a mix takes, so that each source gives its target.

    Returns doc_id, size (words of the whole text; null and blank: 0), source_size, target, taken (size times
    copies) and copies, one row per row of `documents`, of which doc_id, source and text are read. Targets are
    those of `source_targets`; copies are floor or ceiling of target / source_size, so nothing exceeds `most`
    times its size if `most` is whole. A null source is a source of its own. Repeated rows and rows without a doc_id count as they come.
    An empty table gives an empty result.

    Groups for rounding go by a hash of the row, so reruns agree, however the table is cut into files. Only rows that are equal and
    thousands in number are dealt over groups by their place; there, reruns over the same files agree.
    Each group rounds all but a residual and a few documents of each size, at most about 30 rows a source; these meet in groups of 16 until one group is left.
    """
    scratch = Scratch(documents.sparkSession, "mix")
    text = F.col("text").cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    rows = documents.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), size.alias("size"), F.xxhash64("doc_id", "source", text).alias("key"))
    rows = scratch.write(rows, "sizes")
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1)  # files are listed in any order
    rows = rows.withColumn("place", F.xxhash64(number, F.col("_metadata.row_index")))
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rates = source_targets(sums, total_share, most, weights).withColumnRenamed("source", "_source")
    rates = rates.withColumn("whole", F.floor(rate)).withColumn("share", rate - F.floor(rate))
    rated = rows.join(rates, F.col("_source").eqNullSafe(F.col("source")))
    divisible = (F.col("size") > 0) & (F.col("share") > _EDGE) & (F.col("share") < 1 - _EDGE)
    extra = F.when(divisible, -1).when(F.col("share") >= 0.5, 1).otherwise(0).alias("extra")
    nodes = max(1, -(-rows.count() // LEAF))
    # Rows that are equal share a key; a key of many rows is dealt over several groups.
    many = rows.groupBy("key").agg(F.ceil(F.count("*") / SHARE).alias("parts")).where("parts > 1").withColumnRenamed("key", "_key")
    rated = rated.join(many, F.col("_key") == F.col("key"), "left")
    part = F.pmod("place", F.coalesce("parts", F.lit(1)))
    node = F.pmod(F.col("key") + part, F.lit(nodes)).alias("node")
    rated = scratch.write(rated.select("doc_id", "source", "size", "source_size", "target", "whole", "share", "key", extra, node), "rates")

    parts, level = [rated.where("extra >= 0")], 0
    todo, last = rated.where("extra < 0"), False
    while not last:
        last = level > 0 and nodes == 1
        keys = ["source", "node"] if level else ["node"]
        done = todo.groupBy(*keys).applyInArrow(_rounding(level, last), _ROWS)
        done = scratch.write(done, "rounded")
        parts.append(done.where("extra >= 0"))
        todo = done.where("extra < 0").withColumn("node", F.floor(F.col("node") / FANOUT))
        nodes, level = -(-nodes // FANOUT), level + 1
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    copies = F.col("whole") + F.col("extra")
    return out.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"))


def _rounding(level: int, last: bool):
    def run(rows: pa.Table) -> pa.Table:
        return _round_group(rows, level, last)

    return run
