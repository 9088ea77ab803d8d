import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

FIXTURES = ROOT / "tests" / "fixtures"
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kontor.session import build_session

    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    s = build_session(
        "local[4]",
        app_name="kontor-tests",
        shuffle_partitions=4,
        extra={"spark.driver.memory": "4g", "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="kontor-wh-")},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="kontor-test-")
