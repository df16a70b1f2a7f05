"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest
from check_oracles import compare, connect

from cardwarden.catalog import ORACLES, QUERIES

HEAVY = {"tune_report", "cross_validate", "cross_validate_trees", "evaluate_saved", "tune_gbt", "tune_logistic"}


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, sf_dir, name):
    assert compare(spark, db, sf_dir, name) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - HEAVY))
def test_query_without_sql_gives_rows(spark, db, sf_dir, name):
    assert compare(spark, db, sf_dir, name) == ""
