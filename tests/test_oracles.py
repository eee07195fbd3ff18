"""Every registered query agrees with its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

from runlens import plans
from tests.check_oracles import compare, duck

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(plans.all_queries()) == set(plans.all_oracles())


@pytest.mark.parametrize("name", sorted(plans.all_queries()))
def test_query_matches_sql(spark, con, name):
    assert compare(plans.all_queries()[name](spark, SF_DIR), con, plans.all_oracles()[name]) is None
