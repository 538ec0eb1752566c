"""Every named query against its SQL, over the whole tables."""

import os

import pytest

import __spark_entry__ as entry
import check

FOLDER = os.environ.get("CATALOG_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return check.oracle(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in SQL:
        assert check.compare(df, con, SQL[name]) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["conv_id", "n_messages", "n_tokens", "n_kept", "kept_md5"]
    assert df.count() > 0
