from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventmart.session import build_session, scratch_path  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    conf = {}
    # tests set their own checkpoint root only where the session has none
    if not os.environ.get("SPARK_CONF_DIR"):
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="eventmart-test-ckpt-")
    s = build_session(app="eventmart-tests", master="local[*]", shuffle_partitions=8, conf=conf)
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    def make(name: str = "t") -> str:
        return scratch_path(spark, name)
    return make
