import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from quire.session import get_spark

    ckpt = tempfile.mkdtemp(prefix="quire-test-ckpt-")
    s = get_spark("local[*]", app="quire-tests", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.checkpoint.dir": ckpt,
    })
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="quire-test-")
