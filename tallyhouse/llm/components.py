"""Connected components by rounds of large-star and small-star joins.

Every step is an aggregation (combined before the shuffle, so a hub sends one row per task) or an
equi-join that adaptive execution can split. Nothing is collected but one checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.scratch import Scratch

MAX_ROUNDS = 60


def connected_components(links: DataFrame, scratch: Scratch, rounds: int | None = None) -> DataFrame:
    """(id, component) for every id that has a link; component is the smallest id it reaches.

    `links` has two long columns a and b. Nulls, self-links and repeated links are ignored; an empty
    table gives an empty one. With `rounds`, work ends after so many: component is then an id that is reached, and
    not always the same in all of a component.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    table = scratch.write(edges.distinct(), "edges")
    before = None
    for k in range(rounds or MAX_ROUNDS):
        both = table.unionByName(table.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").selectExpr("if(v = m, u, v) AS u", "m AS v").where("u <> v").distinct()
        last, table = table, scratch.write(small, "edges")
        scratch.drop(last)
        if rounds is not None:
            if k + 1 < rounds:
                continue
            own = table.select(F.col("v").alias("id"), F.col("v").alias("component"))
            reached = table.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(own)
            return reached.groupBy("id").agg(F.min("component").alias("component"))
        now = table.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            roots = table.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            return table.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
        before = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
