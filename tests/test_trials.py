"""Every trial query equals its SQL on the small test tables."""

from __future__ import annotations

import pytest

import tidemark.trials as trials
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
trials.load_all()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(trials.QUERIES) == set(trials.ORACLES)


@pytest.mark.parametrize("name", list(trials.QUERIES))
def test_equals_sql(spark, con, name):
    _, problems = compare(spark, SF_DIR, name, con)
    assert not problems, problems
