"""Every registered query against its SQL oracle on the smallest tables."""

import pytest
from oracle_check import difference

from lakefold.plans.oracle import ORACLE
from lakefold.plans.registered import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, name):
    assert difference(spark, SF_DIR, name) is None


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
    # Queries of the optional subpackage may have no SQL.
    assert set(QUERIES) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
