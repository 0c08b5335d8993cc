"""Every query of the metadata operators against its SQL."""

from __future__ import annotations

import pytest

from metagauge.plans import queries as plans

SQL = plans.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, same_rows):
    same_rows(plans.queries()[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(SQL)))
def test_query_without_sql_runs(name, spark, sf):
    assert plans.queries()[name](spark, sf).count() > 0


def test_entry_point_is_whole(spark):
    import __spark_entry__ as e

    assert set(plans.queries()) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() == 11
