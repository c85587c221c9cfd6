import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
DATA = os.environ.get("QUIREBASE_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from quirebase import build_session

    folder = tempfile.mkdtemp(prefix="spark-")
    os.environ["QUIREBASE_SCRATCH"] = f"{folder}/scratch"
    session = build_session("local[4]", 4, "tests", spark__driver__memory="4g", spark__local__dir=f"{folder}/local", spark__sql__warehouse__dir=f"{folder}/warehouse")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"
