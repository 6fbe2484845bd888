"""Every registered query beside its SQL twin, on the smallest tables."""

from __future__ import annotations

import pytest
from compare import connect, difference

from __spark_entry__ import entry
from deskloom.catalog import queries
from deskloom.oracles import oracle_sql

SF = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_every_query_has_a_twin():
    assert set(queries()) == set(SQL)


@pytest.mark.parametrize("name", list(queries()))
def test_query_matches_twin(spark, db, name):
    count, problem = difference(queries()[name](spark, SF), db, SQL[name])
    assert problem is None
    assert count > 0


def test_entry(spark):
    df = entry(spark)
    assert len(df.columns) == 19
    assert df.count() == 1349
