"""Every registered query of the operators against its SQL; those without SQL run and have rows."""

import pytest
from oracle import differences

from threadline.plans import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, tiny, name):
    assert differences(spark, QUERIES[name], ORACLE_SQL[name], tiny) == ([], [])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_without_sql(spark, tiny, name):
    assert QUERIES[name](spark, tiny).columns


def test_entry(spark, tiny):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
