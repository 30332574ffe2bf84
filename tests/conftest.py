import os

import pytest

from salesprism.session import local_session
from oracle import TABLES


@pytest.fixture(scope="session")
def spark():
    return local_session(os.environ.get("TEST_CPUS", "8"))


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def duck(folder):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')"
        )
    return connection
