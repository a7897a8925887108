"""Every registered query against its DuckDB statement on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from check import compare, duck  # noqa: E402
from conftest import SMALL  # noqa: E402
from docfleet.queries import load_all  # noqa: E402

QUERIES = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    state, note = compare(QUERIES[name], spark, con, SMALL)
    assert state in ("OK", "ROWS", "EMPTY"), note
    assert "TYPE" not in note, note


def test_every_inventory_item_has_a_query():
    wanted = {
        **{f"S{i}": 1 for i in range(1, 8)}, **{f"P{i}": 1 for i in range(1, 17)}, **{f"T{i}": 1 for i in range(1, 17)},
        **{f"J{i}": 1 for i in range(1, 14)}, **{f"A{i}": 1 for i in range(1, 17)}, **{f"W{i}": 1 for i in range(1, 12)},
        **{f"U{i}": 1 for i in range(1, 5)}, **{f"H{i}": 1 for i in range(1, 14)}, **{f"ST{i}": 1 for i in range(1, 8)},
        "F1": 1, "F2": 1,
    }
    assert not wanted.keys() - {q.item for q in QUERIES.values()}
