"""Every registered query against its DuckDB oracle on the smallest tables
(row count, column names, order-insensitive value digest)."""

import pytest

import __spark_entry__ as entry
from scripts.check_oracle import compare, duck

SF = "/root/testdata/sf0.001"
KEYS = sorted(entry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", KEYS)
def test_against_oracle(spark, con, key):
    r = compare(spark, con, key, entry.queries()[key], entry.oracle_sql().get(key), SF)
    assert r["status"] in ("match", "match~float", "rows-only"), r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[-1] == "snapshot_date"


def test_every_key_has_oracle():
    from auric.plans.registry import ORACLE, QUERIES
    missing = set(QUERIES) - set(ORACLE)
    assert not missing, missing
