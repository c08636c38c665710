import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

DATA = os.environ.get("STRATA_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from strata.session import local_session

    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, "strata-tests", **{"spark.checkpoint.dir": shared})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture()
def path(tmp_path):
    return lambda name: f"{tmp_path}/{name}"
