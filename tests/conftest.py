import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from screenrank.session import get_session
    ckpt = tempfile.mkdtemp(prefix="screenrank-test-ckpt-")
    s = get_session("local[4]", app="screenrank-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
