"""Every query with a SQL oracle, on the smallest driver tables."""

from __future__ import annotations

from pathlib import Path

import pytest

from matchlake.harness import tables
from matchlake.harness.check import compare
from matchlake.harness.oracles import oracle_sql
from matchlake.harness.queries import queries

SF_DIR = "/root/testdata/sf0.001"
ORACLES = oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not present")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_oracle(spark, name):
    assert compare(spark, SF_DIR, queries()[name], ORACLES[name]) is None


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(queries())


def test_odds_events_come_from_one_scan(spark):
    """They were joined with the orders that the matches come from already."""
    plan = tables.landed_odds(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
