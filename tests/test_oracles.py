"""Every registered query beside its SQL twin on the smallest tables."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()

# The smallest tables have too few rows for these to find anything; the larger ones do.
EMPTY_OK = {"srt4_forced_winner"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    build = entry.queries()[name]
    if name not in ORACLES:
        assert build(spark, SF_DIR).count() > 0
        return
    problem = compare(spark, con, SF_DIR, build, ORACLES[name])
    if problem == "empty on both sides":
        pytest.skip("no rows at this scale")
    assert problem is None, problem


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
