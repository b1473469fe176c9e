import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fareweave.session import local_session  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = local_session(os.environ.get("TEST_CORES", "8"), "tests", {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="fareweave-tests-")})
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def rides(spark, small):
    from fareweave.sources.events import load_rides
    from fareweave.storage import materialize

    return materialize(load_rides(spark, small), "test-rides")
