"""Every registered query against its SQL, on the smallest tables."""

import pytest

from checks.compare import compare
from checks.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    mine, theirs, my_names, their_names = compare(spark, SF, QUERIES[name], ORACLES[name])
    assert my_names == their_names
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 29
