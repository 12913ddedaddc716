import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from stockroom.session import build_session
    s = build_session("local[*]", 8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables001(spark):
    from stockroom.sources import load
    return load(spark, SF001, register=False)
