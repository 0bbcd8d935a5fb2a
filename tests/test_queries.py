"""Every registered query against its SQL on the same tables."""

import re

import compare
import pytest

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return compare.duck(folder)


def test_every_query_has_sql():
    assert {n for n in entry.queries() if not re.match("op[0-9]+_|pipeline", n)} <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, folder, con, name):
    assert compare.difference(entry.queries()[name](spark, folder), con, ORACLES[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["zone", "violation_type", "total_violations"]
