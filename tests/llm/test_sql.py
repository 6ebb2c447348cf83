import pytest
from compare import mismatch, oracle

from snapsync.llm.queries import oracle_sql, queries


@pytest.mark.parametrize("name", oracle_sql())
def test_query_matches_its_sql(spark, sf_dir, name):
    assert mismatch(queries()[name](spark, sf_dir), oracle(sf_dir), oracle_sql()[name]) is None
