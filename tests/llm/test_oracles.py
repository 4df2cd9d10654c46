"""Registered queries with a SQL counterpart, on the smallest test data."""

from __future__ import annotations

import os

import pytest

from shelfcast.llm.oracles import oracle_sql
from shelfcast.llm.queries import queries
from tests.compare import connect, differences

SF = os.environ.get("SHELFCAST_TEST_SF", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name):
    got = queries()[name](spark, SF).toPandas()
    assert differences(got, connect(SF).sql(oracle_sql()[name]).df()) is None
    assert len(got) > 0
