import pytest
from compare import mismatch, oracle

import __spark_entry__ as entry

QUERIES = entry.copy_queries()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle(sf_dir)


def test_every_query_has_sql():
    assert set(entry.copy_sql()) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_its_sql(spark, sf_dir, connection, name):
    df = QUERIES[name](spark, sf_dir)
    assert mismatch(df, connection, entry.copy_sql()[name]) is None


def test_entry(spark):
    copied = entry.entry(spark).collect()
    assert len(copied) == 14 and {r.status for r in copied} == {"ok"}
