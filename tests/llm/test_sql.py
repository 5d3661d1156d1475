"""Registered queries of this package against their SQL."""

import oracle
import pytest

from layerwright.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert oracle.compare(QUERIES[name](spark, SF_DIR), oracle.connect(SF_DIR), ORACLES[name]) is None
