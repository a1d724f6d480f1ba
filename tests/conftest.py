import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from acoustispark.session import get_session
    s = get_session("local[4]", 8, extra={"spark.ui.enabled": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


SF = "/root/testdata/sf0.001"
