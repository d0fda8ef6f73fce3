"""Every core query on the smallest tables: against its SQL where it has one, else that it runs and repeats itself."""

import pytest

from lexmill.plans import queries as plans
from oracle import connect, rows

SQL = plans.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, small, name):
    got = rows(plans.queries()[name](spark, small).toPandas())
    assert got == rows(connect(small).execute(SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(SQL)))
def test_runs_and_repeats(spark, small, name):
    one, two = (rows(plans.queries()[name](spark, small).toPandas()) for _ in range(2))
    assert one == two and one[1]


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
