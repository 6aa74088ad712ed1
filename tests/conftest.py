import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from sparkpanel.session import get_session

    s = get_session("tests", "local[4]", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def rows():
    def collect(df, *cols):
        out = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in out.collect()), key=lambda t: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in t))
    return collect
