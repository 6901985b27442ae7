import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)


@pytest.fixture(scope="session")
def spark():
    from histrail.session import local_session

    session = local_session(4, 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SMALL = "/root/testdata/sf0.001"
