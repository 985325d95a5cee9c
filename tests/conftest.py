import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shopflow.config import build_session

    warehouse = tempfile.mkdtemp(prefix="shopflow-wh-")
    s = build_session(
        "local[4]",
        app_name="shopflow-tests",
        shuffle_partitions=4,
        extra_conf={"spark.sql.warehouse.dir": warehouse, "spark.driver.memory": "4g"},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="shopflow-test-")
