"""Every registered query against its SQL."""
import pytest
from oracle import compare, open_tables

import __spark_entry__ as entry

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return open_tables(sf_dir)


# Queries of the optional subpackage without SQL have tests of their own.
@pytest.mark.parametrize("key", sorted(set(entry.QUERIES) | set(ORACLE)))
def test_query(spark, sf_dir, con, key):
    df = QUERIES[key](spark, sf_dir)
    if key in ORACLE:
        assert compare(df, con, ORACLE[key]) == []
    else:
        assert df.count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["l_orderkey", "o_orderdate", "revenue", "n_lines"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
