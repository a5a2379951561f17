import pytest
from compare import spark_rows, sql_rows

from tidewell.plans.catalog import QUERIES, SQL


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, sf_dir, name):
    assert spark_rows(QUERIES[name](spark, sf_dir)) == sql_rows(SQL[name], sf_dir)


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
