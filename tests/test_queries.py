"""Every query against its oracle on the smallest tables."""

import pytest
import support

from gridflux import catalog


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf_dir, name):
    got = catalog.QUERIES[name](spark, sf_dir).toPandas()
    if name in catalog.ORACLE_SQL:
        assert support.same(got, support.oracle(catalog.ORACLE_SQL[name], sf_dir)) == ""
    else:
        assert len(got)


def test_entry_imports_without_llm():
    import __spark_entry__ as e

    assert set(catalog.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
