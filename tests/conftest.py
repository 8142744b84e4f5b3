import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import get_spark
    ck = tempfile.mkdtemp(prefix="tidemark-test-ckpt-")
    s = get_spark("local[4]", app="tidemark-tests", **{"spark.sql.shuffle.partitions": "8",
                                                       "spark.checkpoint.dir": ck})
    yield s
    s.stop()
