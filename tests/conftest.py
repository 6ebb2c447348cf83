import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from session import new_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = new_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


def rows(df):
    """Rows as sorted tuples, NULLs first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is not None, v) for v in t])


@pytest.fixture
def write_tables(spark, tmp_path):
    """Write DataFrames as a directory of tables -> its path."""

    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/source/{name}.parquet")
        return f"{tmp_path}/source"

    return write
