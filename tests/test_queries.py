"""Every registered query with SQL gives what DuckDB gives."""

from __future__ import annotations

import oracle
import pytest

from costlens.plans.catalogue import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE_SQL])
def test_query(spark, sf_dir, con, name):
    missing, extra, rows = oracle.compare(QUERIES[name](spark, sf_dir), con, ORACLE_SQL[name])
    spark.catalog.clearCache()
    assert not missing and not extra and rows


def test_entry_imports(spark):
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
