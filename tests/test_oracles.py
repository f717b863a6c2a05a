"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare_util import compare, duck

SF_DIR = "/root/testdata/sf0.001"
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in entry.CORE_QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(entry.CORE_QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    r = compare(df, con, ORACLES[name])
    assert r["columns_match"], (r["spark_cols"], r["duck_cols"])
    assert r["rows"][0] == r["rows"][1]
    assert r["hash_match"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["postal_code", "observation_hour", "temperature", "precipitation",
                          "relative_humidity", "wind_speed"]
    assert df.count() == 6720
