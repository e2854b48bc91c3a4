"""Every registered query against its SQL twin on the smallest sample."""

import os
import re

import pytest

import __spark_entry__ as entry_point
from compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not present")
# training-data queries have tests of their own
QUERIES = {n: q for n, q in entry_point.queries().items() if not re.match(r"op\d+_|pipeline$", n)}
TWINS = {n: sql for n, sql in entry_point.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_twin_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    without = set(QUERIES) - set(TWINS)
    assert without == {"ml_model_comparison", "ml_best_model", "ml_feature_importance", "ml_coefficients"}


@pytest.mark.parametrize("name", sorted(TWINS))
def test_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, TWINS[name]) == []


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0
