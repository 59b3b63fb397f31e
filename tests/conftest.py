import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keelson.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    wh = tempfile.mkdtemp(prefix="keelson-warehouse-", dir="/tmp")
    s = build_session("local[4]", "keelson-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g", "spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL
