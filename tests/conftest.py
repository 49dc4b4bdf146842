import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from fareline.session import get_session

    import tempfile

    s = get_session("local[*]", shuffle_partitions=8, **{"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="fareline-wh-")})
    yield s
    s.stop()
