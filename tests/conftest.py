import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from mergetide.session import build, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build("local[2]", "tests", spark__sql__shuffle__partitions="2", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="3g", spark__driver__host="127.0.0.1")
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()
