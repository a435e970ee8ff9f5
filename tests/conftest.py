import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
here = Path(__file__).parent
os.environ["PYTHONPATH"] = os.pathsep.join([str(here.parent), str(here), os.environ.get("PYTHONPATH", "")])  # for the workers
os.environ.setdefault("PLOTWEAVE_DRIVER_MEMORY", "4g")


@pytest.fixture(scope="session")
def spark():
    from plotweave.session import local_session

    s = local_session(4, 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tiny():
    """The smallest test data, or a skip where they aren't installed."""
    where = Path(os.environ.get("PLOTWEAVE_TESTDATA", "/root/testdata/sf0.001"))
    if not where.exists():
        pytest.skip("no test data")
    return str(where)
