import duckdb
import pytest

from tallyhouse.llm.oracles import oracle_sql
from tallyhouse.llm.queries import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = con.execute(oracle_sql()[name])
    columns = [c[0] for c in found.description]
    got = queries()[name](spark, SF).select(*columns).collect()
    assert sorted(map(tuple, got), key=str) == sorted(found.fetchall(), key=str)


def test_every_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries())
    assert numbers == list(range(1, 14))
