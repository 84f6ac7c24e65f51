import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sigflow.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
# The 99-row sample of 10-minute readings the golden tests use (header row,
# UTF-8 BOM, CRLF). Not part of this repository: point the variable at it.
SAMPLE_CSV = os.environ.get("SIGFLOW_SAMPLE_CSV", "")


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture()
def scratch(spark):
    from sigflow.session import new_scratch_dir

    path = new_scratch_dir(spark, "test")
    if path.startswith("file:"):
        path = path[len("file:"):]
    os.makedirs(path, exist_ok=True)
    return path
