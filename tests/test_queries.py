"""Every registered query against its SQL, or for rows if it has none."""

import __spark_entry__ as entry
import pytest
from compare import difference

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, folder, name):
    assert difference(spark, folder, QUERIES[name], ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_gives_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_checks_belong_to_queries():
    assert set(ORACLE) <= set(QUERIES)
