import pytest

from __spark_entry__ import entry
from tallyhouse.checks.compare import connect, difference
from tallyhouse.checks.oracles import oracle_sql
from tallyhouse.checks.queries import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", list(queries()))
def test_query_equals_sql(spark, con, name):
    rows, problem = difference(spark, con, SF_DIR, name)
    assert not problem and rows > 0


def test_results_do_not_depend_on_the_session_zone(spark, con, zone):
    zone("America/New_York")
    for name in ("stg_sales", "report_daily_sales", "stg_sales_incremental", "lifecycle_lookback"):
        assert difference(spark, con, SF_DIR, name)[1] == ""


def test_entry(spark):
    assert entry(spark).count() == 40
