"""Queries against their SQL twins."""

import pytest
from oracle_compare import connect, differences

from vetrail.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    assert differences(QUERIES[name](spark, folder), connect(folder), ORACLE[name]) == []
