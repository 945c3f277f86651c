"""Every registered query against its SQL."""

import pytest
from checker import differences, duck
from conftest import SF

import __spark_entry__ as entry_module
from catalog import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    got = entry_module.queries()[name](spark, SF).toArrow()
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        assert got.num_rows > 0
    else:
        assert differences(got, con.sql(sql).to_arrow_table()) == []


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0
