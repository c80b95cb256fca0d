import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from keyloop.session import build_session
    # tests set their own checkpoint folder (it is unset in a local session)
    chk = tempfile.mkdtemp(prefix="keyloop-test-")
    wh = tempfile.mkdtemp(prefix="keyloop-warehouse-")
    s = build_session(master="local[4]", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": chk, "spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"
