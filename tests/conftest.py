import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


def new_scratch() -> str:
    """A fresh scratch folder for one run (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def spark():
    from quayside.session import build_session
    run = new_scratch()
    s = build_session("local[8]", 8, app_name="quayside-tests",
                      extra={"spark.sql.warehouse.dir": os.path.join(run, "warehouse"),
                             "spark.sql.streaming.forceDeleteTempCheckpointLocation": "false"})
    from quayside.session import checkpoint_root
    checkpoint_root(s, default=os.path.join(run, "checkpoints"))   # only where unset
    yield s


@pytest.fixture
def scratch():
    return new_scratch()
