"""Every corpus query that SQL can express, against its SQL."""

import pytest

from matchlake.harness.check import compare
from matchlake.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert compare(spark, sf_dir, queries.queries()[name], queries.oracle_sql()[name]) is None


def test_all_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.queries())
    assert numbers == list(range(1, 14))
