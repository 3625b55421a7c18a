import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

# The literal fixtures are a few rows each: planning and compiling would take
# all the time. Plans that matter are checked with the settings they need.
SMALL = {
    "spark.sql.shuffle.partitions": "2",
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.codegen.wholeStage": "false",
}


@pytest.fixture(scope="session")
def session():
    from millrace.session import local_session

    return local_session()


@pytest.fixture
def spark(session, request):
    """The session with settings for tiny data; ``default_conf`` tests keep Spark's own."""
    if request.node.get_closest_marker("default_conf"):
        yield session
        return
    old = {k: session.conf.get(k) for k in SMALL}
    for k, v in SMALL.items():
        session.conf.set(k, v)
    yield session
    for k, v in old.items():
        session.conf.set(k, v)


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def con(sf):
    from tests.oracle import duck

    return duck(sf)


def pytest_configure(config):
    config.addinivalue_line("markers", "default_conf: run with Spark's own settings")
