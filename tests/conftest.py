import os
import sys
import tempfile

import pytest
from hypothesis import HealthCheck, settings

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")
TESTDATA = "/root/testdata"

# floats(width=16) refuses what overflows 16 bits, and by chance so often that Hypothesis gives up
settings.register_profile("tessera", suppress_health_check=[HealthCheck.filter_too_much])
settings.load_profile("tessera")


@pytest.fixture(scope="session")
def spark():
    from tessera.session import local_session
    s = local_session("*", 8, app_name="tessera-tests")
    # tests own their session: set a scratch checkpoint dir only because none is configured
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from tessera.session import scratch_path

    def make(name):
        return scratch_path(spark, name)
    return make


def fixture(name: str) -> str:
    return os.path.join(FIXTURES, name)


def rows(df):
    return [tuple(r) for r in df.collect()]
