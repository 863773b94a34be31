"""Every registered query agrees with its SQL on the smallest tables."""

import pytest
from oracle import differences, duck

from sheafline.checks import CHECKS


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_agrees_with_sql(spark, con, sf_dir, name):
    check = CHECKS[name]
    df = check.run(spark, sf_dir)
    assert not differences(df, con, check.sql)


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
