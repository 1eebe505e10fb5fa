"""Each registered query against its SQL twin."""

import pytest
from check import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from tidewater.plans.oracle import ORACLE
from tidewater.plans.queries import QUERIES
from tidewater.plans.stream_queries import STREAM_QUERIES



@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_all_queries_have_a_twin():
    own = {**QUERIES, **STREAM_QUERIES}
    assert set(own) == set(ORACLE)
    assert not set(oracle_sql()) - set(queries())


# Queries whose pattern is too rare at the smallest scale.
SPARSE = {"login_fail_timer"}


@pytest.mark.parametrize("name", sorted({**QUERIES, **STREAM_QUERIES}))
def test_query(name, spark, con, sf):
    ok, note = compare(spark, con, name, queries()[name], oracle_sql().get(name), sf)
    assert ok or (name in SPARSE and note.startswith("0 rows,")), note


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["window_end", "item_id", "cnt", "rn"]
    assert df.count() > 0
