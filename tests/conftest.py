import pytest

from carestar.session import build_session, scratch_dir
from carestar.sources.store import TableStore


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def folder(spark):
    return scratch_dir(spark, "test")


@pytest.fixture
def store(spark, folder):
    return TableStore(spark, folder)
