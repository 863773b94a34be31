"""Every query with SQL agrees with it, and all thirteen operators and the pipeline are registered."""

import re

import pytest
from oracle import differences, duck

from sheafline.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, sf_dir, name):
    assert not differences(QUERIES[name](spark, sf_dir), duck(sf_dir), SQL[name])


def test_all_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert sorted(int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))) == list(range(1, 14))
    assert "pipeline" in names
