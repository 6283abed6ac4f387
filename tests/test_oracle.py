"""Every registered query with an oracle equals DuckDB on the same Parquet."""

import pytest

import __spark_entry__ as E
from oracle import compare, duck

from conftest import SF_SMALL

SQLS = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    if name not in SQLS:
        assert df.count() >= 0
        return
    r = compare(df, con, SQLS[name])
    assert r["columns_match"], r
    assert r["rows_spark"] == r["rows_oracle"], r
    assert r["hash_match"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == [
        "data_node", "hypertable_schema", "hypertable_name", "table_bytes", "index_bytes", "toast_bytes",
        "total_bytes", "max_total_bytes_dn", "highest_loaded_dn",
    ]
