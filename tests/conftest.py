import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkwatch import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    base = tempfile.mkdtemp(prefix="sparkwatch-tests-")
    s = session(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g",
        spark__checkpoint__dir=base,
        spark__sql__warehouse__dir=f"{base}/warehouse",
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def root(spark):
    from sparkwatch import scratch_path

    return scratch_path(spark, "test")
