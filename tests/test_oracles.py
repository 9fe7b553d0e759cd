"""Every SQL-checked query against its DuckDB oracle (row count, names,
types and order-insensitive values) on the smallest fixture."""
import pytest

from conftest import SMALL
from oracle_harness import compare, duck

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    got = QUERIES[name](spark, SMALL).toArrow()
    want = duck(ORACLES[name], SMALL)
    assert compare(got, want) == []


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["dimension", "key1", "key2"]
    assert df.count() > 0
