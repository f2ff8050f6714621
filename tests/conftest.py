import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from linkgraph.session import build_session  # noqa: E402
from wiki14 import WIKI14  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4, app="linkgraph-tests")
    yield s


@pytest.fixture(scope="session")
def wiki14(spark):
    from linkgraph.plans.jobs import ingest_lines

    lines = spark.createDataFrame([(x,) for x in WIKI14], "value string")
    return ingest_lines(lines)
