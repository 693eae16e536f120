import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from trackloom.session import session

    s = session("local[4]", "tests", spark__sql__shuffle__partitions="4", spark__driver__memory="4g", spark__sql__adaptive__coalescePartitions__enabled="true")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
