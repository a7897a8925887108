import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from docfleet.plans.runtime import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "8", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tight(monkeypatch):
    """Limits so low that tiny tables take the paths meant for heavy keys and long groups."""
    from docfleet.plans import ordered

    monkeypatch.setattr(ordered, "POSITIONS_PER_PIECE", 3)
    monkeypatch.setattr(ordered, "ROWS_PER_PART", 4)
