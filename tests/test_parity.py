from __future__ import annotations

import pytest
from parity import assert_same, connect

from docpipe.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_says_what_its_sql_says(spark, small, name):
    assert_same(catalog.queries()[name](spark, small), connect(small), catalog.oracle_sql()[name])


def test_every_query_without_sql_runs(spark, small):
    for name in set(catalog.queries()) - set(catalog.oracle_sql()):
        assert catalog.queries()[name](spark, small).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1
