import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


@pytest.fixture(scope="session")
def spark():
    from sensorlake.session import build_session
    scratch = tempfile.mkdtemp(prefix="sensorlake-test-")
    s = build_session("local[4]", 4, app_name="sensorlake-tests", extra={
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
        "spark.driver.memory": "6g",
    })
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="sensorlake-case-")
