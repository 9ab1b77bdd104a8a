import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from reckon.session import session

    s = session("local[8]", "tests", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="6g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
