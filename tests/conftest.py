import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from folioflow.session import local_session, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    ship(s)
    yield s
    s.stop()
