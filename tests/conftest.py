import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from demandloom.session import local_session
    from demandloom.sources import drop_staged

    folder = tmp_path_factory.mktemp("shared")
    session = local_session(8, folder=str(folder))
    yield session
    drop_staged(session)
    left = [p for p in folder.rglob("*") if p.is_file()]
    session.stop()
    assert not left


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)
    return collect
