"""The queries that SQL can express, on the smallest tables."""

import pytest
from compare import compare, connect

import __spark_entry__ as registered
from sensorloom.llm.oracles import ORACLES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, sf, name):
    frame = registered.queries()[name](spark, sf)
    assert compare(frame, connect(sf), registered.oracle_sql()[name]) == []
