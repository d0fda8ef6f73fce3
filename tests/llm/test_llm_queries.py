"""pN_ queries on the smallest tables: against SQL where there is some."""

import pytest

from lexmill.llm import queries, sql
from oracle import connect, rows

SQL = sql.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, small, name):
    got = rows(queries.queries()[name](spark, small).toPandas())
    assert got == rows(connect(small).execute(SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(SQL)))
def test_runs(spark, small, name):
    df = queries.queries()[name](spark, small)
    got = df.toPandas()
    if name.endswith("_found"):
        assert not got.duplicated().any()
    assert len(got)
