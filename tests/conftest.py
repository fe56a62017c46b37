import os

import pytest

from tallyline.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tallyline-tests", "8", shuffle_partitions=4, shared=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    """The tables the queries run on; the smallest scale unless TEST_SF_DIR names another."""
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
