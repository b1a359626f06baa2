import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from siteplan.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", cpus=8, shuffle_partitions=8, spark__driver__memory="6g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
