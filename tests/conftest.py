import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from peertide.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 4)
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture
def rows():
    def run(df):
        cols = sorted(df.columns)
        return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)

    return run
