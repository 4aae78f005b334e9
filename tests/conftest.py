import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from traitlab.session import build_session
    s = build_session("local[4]", shuffle_partitions=4,
                      extra={"spark.sql.session.timeZone": "UTC"})
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="traitlab-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="traitlab-test-")


@pytest.fixture(scope="session")
def ctx001(spark):
    from traitlab.plans.context import JobContext
    return JobContext(spark, SF001)


@pytest.fixture(scope="session")
def ctx01(spark):
    from traitlab.plans.context import JobContext
    return JobContext(spark, SF01)
