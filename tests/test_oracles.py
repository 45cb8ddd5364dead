"""Every query of the catalog against its SQL oracle, on the smallest tables."""

import pytest
from compare import compare, connect

import __spark_entry__ as registered
from sensorloom.plans.catalog import QUERIES
from sensorloom.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def con(sf_dir="/root/testdata/sf0.001"):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_registration():
    assert set(QUERIES) <= set(registered.queries())
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, con, name):
    frame = QUERIES[name](spark, sf)
    assert compare(frame, con, ORACLES[name]) == []
