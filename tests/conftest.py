import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session

    s = build_session("strata-tests", master="local[4]", shuffle_partitions=4,
                      extra={"spark.driver.memory": "4g"})
    # Tests set their own shared folder only where the environment does not name one.
    if not s.sparkContext.getConf().get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="strata-test-ckpt-"))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_uri(tmp_path):
    return str(tmp_path)
