"""Every registered query against its DuckDB oracle, at sf 0.001 (the driver
does the same at sf 0.01)."""

import os

import pytest

import __spark_entry__ as E
from compare import digest, duck
from raw2clean.plans import registry

SF = "/root/testdata/sf0.001"
NAMES = sorted(registry.Q)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["code", "state_code", "county_code", "tract",
                                             "census_tract", "amount", "label", "age"]


def test_every_query_has_an_oracle():
    assert set(registry.ORACLE_SQL) == set(registry.Q)
    assert set(registry.Q) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.sql(E.oracle_sql()[name])
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(res.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(res.columns, orows)[0]
