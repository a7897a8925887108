"""The queries on file trees against DuckDB, on odd documents and in a session without filter pushdown."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from check import compare, duck  # noqa: E402
from conftest import SMALL  # noqa: E402
from docfleet.plans.runtime import scratch_path  # noqa: E402
from docfleet.queries import load_all  # noqa: E402
from docfleet.sources import files as SF  # noqa: E402
from docfleet.sources.tree import TreeReader  # noqa: E402

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
ODD = [
    (1, "one\n", "a"), (1, "one\n", "a"), (1, "two\n", "b"),  # one number, several rows
    (2, None, "a"), (3, "", "a"), (4, "", None), (5, None, None), (None, "x", "a"), (-6, "y", ""), (7, "é", ""),
    (8, "text", "a/b"), (9, "text", "a=b&c d+e%2F"), (10, "text", ".."), (11, "text", "venv"), (12, "text", "日本" * 60), (13, "text", "s" * 193),
    (14, "text", "s" * 900 + "/venv"), (15, "a\r\nb", "__HIVE_DEFAULT_PARTITION__"), (16, "a\r\nc", "A"), (17, "\n", "_x"), (18, "z" * 3_000_000, "a"),
    (19, "z" * 3_000_000, "b"), (20, "\x00﻿", "a"),
]


@pytest.fixture
def no_pushdown(spark):
    before = spark.conf.get(PUSHDOWN)
    spark.conf.set(PUSHDOWN, "false")
    yield
    spark.conf.set(PUSHDOWN, before)


@pytest.mark.parametrize("name", ["scan_files", "hash_files"])
def test_without_filter_pushdown(spark, no_pushdown, name):
    state, note = compare(load_all()[name], spark, duck(SMALL), SMALL)
    assert state == "OK" and "TYPE" not in note, note


@pytest.mark.parametrize("name", ["scan_files", "hash_files"])
@pytest.mark.parametrize("rows", [ODD, []], ids=["odd", "none"])
def test_odd_documents(spark, no_pushdown, tmp_path, name, rows):
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    state, note = compare(load_all()[name], spark, con, str(tmp_path))
    assert state == ("OK" if rows else "EMPTY") and "TYPE" not in note, note


def test_files_written_again_stay_whole(spark):
    root = scratch_path(spark, "again")
    files = spark.createDataFrame([("a/b/c", b"12"), ("a/d", None), ("e", b"3")], "path string, content binary")
    for _ in range(2):
        assert SF.write_files(files, root) == 3
    assert sorted((r.path, r.size) for r in SF.scan_files(spark, root).collect()) == [("a/b/c", 2), ("a/d", 0), ("e", 1)]


def test_many_folders_of_one_level_share_tasks(spark, tmp_path):
    names = [f"s{i}/{name}" for i in range(300) for name in ("x", "deep/y")]
    SF.write_files(spark.createDataFrame([(n, b"1") for n in names], "path string, content binary"), str(tmp_path))
    reader = TreeReader({"root": str(tmp_path), "parts": "8"})
    planned = reader.partitions()
    assert len(planned) == 8 and {1 + len(p.more) for p in planned} == {37, 38}
    assert sorted(r["path"] for p in planned for b in reader.read(p) for r in b.to_pylist()) == sorted(names)
    assert sorted(r.path for r in SF.scan_files(spark, str(tmp_path)).collect()) == sorted(names)
