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
    from larkspur.session import build_session
    scratch = tempfile.mkdtemp(prefix="larkspur-tests-")
    s = build_session("local[4]", app="larkspur-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                             "spark.sql.warehouse.dir": os.path.join(scratch, "wh")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from larkspur.session import checkpoint_root
    root = checkpoint_root(spark)
    return tempfile.mkdtemp(prefix="t-", dir=os.path.dirname(root))
