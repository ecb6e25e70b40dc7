import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tracelake.session import local_session

    import tempfile

    warehouse = tempfile.mkdtemp(prefix="tracelake-warehouse-")
    shared = "file://" + tempfile.mkdtemp(prefix="tracelake-shared-")
    conf = {"spark.sql.warehouse.dir": warehouse, "spark.checkpoint.dir": shared}
    s = local_session(4, shuffle_partitions=4, app="tracelake-tests", conf=conf)
    yield s
    s.stop()
