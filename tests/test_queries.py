"""Every registered query against its SQL twin; those without one must give rows."""

import pytest
from __spark_entry__ import entry, oracle_sql, queries
from oracle_compare import connect, differences

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", [q for q in QUERIES if q in SQL])
def test_matches_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, SQL[name]) == []


@pytest.mark.parametrize("name", ["train_logreg", "train_gbt", "champion_scores", "top_drivers"])
def test_model_queries_give_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry_has_the_feature_columns(spark):
    found = entry(spark)
    assert len(found.columns) == 31
    assert found.count() > 0
