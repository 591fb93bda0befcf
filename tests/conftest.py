import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lakemart.session import build_session
    s = build_session("local[4]", "lakemart-tests", shuffle_partitions=8,
                      extra={"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="lakemart-test-")


SMALL_SF = "/root/testdata/sf0.001"
