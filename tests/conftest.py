from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from docpipe.session import get_session

    s = get_session("local[4]", "tests", spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    if not Path(SMALL).exists():
        pytest.skip("no test tables here")
    return SMALL
