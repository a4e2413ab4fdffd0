import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from plume.session import build_session
    ckpt = tempfile.mkdtemp(prefix="plume-test-ckpt-")
    wh = tempfile.mkdtemp(prefix="plume-test-warehouse-")
    s = build_session("local[4]", app="plume-tests", shuffle_partitions=8,
                      conf={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="plume-test-")
