import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from millrace.session import build_session
    ckpt = tempfile.mkdtemp(prefix="millrace-test-ckpt-")
    s = build_session(master="local[4]", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from millrace.plans.scratch import scratch
    return scratch(spark, "test")
