"""Run queries beside their SQL and report rows that differ: python -m tallyhouse.checks.compare [sf] [name ...]"""

from __future__ import annotations

import collections
import sys
import time

import duckdb

from tallyhouse.checks.oracles import oracle_sql
from tallyhouse.checks.queries import queries
from tallyhouse.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def difference(spark, con, sf_dir: str, name: str) -> tuple[int, str]:
    """Row count and a description of the first differences; empty when equal."""
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = collections.Counter(tuple(row) for row in df.select(*columns).collect())
    relation = con.sql(oracle_sql()[name])
    if sorted(relation.columns) != columns:
        return sum(ours.values()), f"columns {columns} and {sorted(relation.columns)}"
    order = ", ".join(f'"{c}"' for c in columns)
    theirs = collections.Counter(con.sql(f"select {order} from ({oracle_sql()[name]}) q").fetchall())
    if ours == theirs:
        return sum(ours.values()), ""
    left, right = list((ours - theirs).items()), list((theirs - ours).items())
    return sum(ours.values()), f"{len(left)} only in ours {left[:3]}, {len(right)} only in SQL {right[:3]}"


def main(sf: str = "0.01", *names: str) -> int:
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = connect(sf_dir)
    failed = 0
    for name in names or oracle_sql():
        begin = time.time()
        try:
            rows, problem = difference(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            rows, problem = -1, repr(error)[:900]
        failed += bool(problem)
        print(f"{name:32} {rows:8} {time.time() - begin:6.2f}s {problem or 'equal'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
