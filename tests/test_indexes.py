"""File trees as a source, the trigram index, and snapshots compared by folder digests, against plain forms."""

import random

import pytest
from pyspark.sql import functions as F

from docfleet.operators import documents as D
from docfleet.operators import history as H
from docfleet.operators import search as X
from docfleet.operators import snapshots as SN
from docfleet.plans.runtime import scratch_path
from docfleet.sources import files as SF
from docfleet.sources.tree import TreeReader


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    names = [f"flat/f{i:02}.txt" for i in range(23)] + [f"a/b{i}/c/d/e/x.md" for i in range(7)] + ["top", ".hidden/.x", "a/node_modules/y", "a/empty/.keep"]
    for i, name in enumerate(names):
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * (i % 5))
    return root, {n: i % 5 for i, n in enumerate(names) if "node_modules" not in n}


@pytest.mark.parametrize("parts, names", [(1, 100), (4, 5), (100, 3)])
def test_tree_is_whole_however_it_is_cut(spark, tree, parts, names):
    root, want = tree
    found = SF.scan_files(spark, str(root), parts=parts, names=names)
    assert {r.path: r.size for r in found.collect()} == want and found.count() == len(want)
    reader = TreeReader({"root": str(root), "exclude": '["node_modules"]', "parts": str(parts), "names": str(names)})
    planned = reader.partitions()
    flat = [p.walk for p in planned if p.folder == "flat"]
    assert flat == {1: [], 4: [True], 100: [False] * 8}[parts]  # walked by one task, or cut by name
    seen = [r["path"] for p in planned for b in reader.read(p) for r in b.to_pylist()]
    assert sorted(seen) == sorted(want)


def test_tree_under_a_prefix(spark, tree):
    root, want = tree
    under = SF.scan_files(spark, str(root), under="a/b3")
    assert [r.path for r in under.collect()] == ["a/b3/c/d/e/x.md"]
    reader = TreeReader({"root": str(root), "parts": "100"})
    from pyspark.sql.datasource import GreaterThan, StringStartsWith

    filters = [StringStartsWith(("path",), "a/b3"), GreaterThan(("size",), 0)]
    assert list(reader.pushFilters(filters)) == filters
    assert {p.folder for p in reader.partitions()} <= {"", "a/b3/c/d/e"}  # no other folder is listed
    assert SF.scan_files(spark, str(root / "flat")).count() == 23
    (root / "nothing").mkdir(exist_ok=True)
    assert SF.scan_files(spark, str(root / "nothing")).count() == 0


@pytest.fixture
def no_pushdown(spark):
    """A session as it comes, where Spark refuses readers that take filters."""
    switch = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(switch)
    spark.conf.set(switch, "false")
    yield
    spark.conf.set(switch, before)


def test_tree_without_filter_pushdown(spark, tree, no_pushdown):
    root, want = tree
    found = SF.scan_files(spark, str(root))
    assert {r.path: r.size for r in found.collect()} == want and found.count() == len(want)
    assert [r.path for r in SF.scan_files(spark, str(root), under="a/b3").collect()] == ["a/b3/c/d/e/x.md"]
    assert SF.scan_files(spark, str(root), under="b3").count() == 0


def test_filters_are_pushed_on_request(spark, tree):
    root, want = tree
    found = spark.read.format("docfleet_file_tree").options(root=str(root), exclude='["node_modules"]', pushdown="true").load()
    kept = found.filter("startswith(path, 'flat/f1') and size > 2")
    assert {r.path: r.size for r in kept.collect()} == {n: s for n, s in want.items() if n.startswith("flat/f1") and s > 2}


TEXTS = ["the cat sat", "a cat", "ca", "", None, "tacacat 日本語 text", "日本", "the the the", "x😀y😀z", "line\nbreak\tTab"]


def test_index_finds_what_a_scan_finds(spark):
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("abc ") for _ in range(rng.randrange(40))) for _ in range(80)]
    files = spark.createDataFrame([(f"{'en' if i % 2 else 'de'}/{i}", t) for i, t in enumerate(texts)], "path string, content string")
    path = scratch_path(spark, "index")
    X.write_search_index(files, path)
    for pattern in ["cat", "the", "ca", "t", "", "日本語", "日本", "😀y😀", "k\tT", "abcab", "nowhere", "the cat sat on", "a b"]:
        assert X.search_index(spark, path, pattern).collect() == D.search_content(files, pattern).collect(), pattern
    assert X.search_index(spark, path, "cat", "en/").collect() == D.search_content(files, "cat", "en/").collect()
    X.write_search_index(files.limit(0), path + "-none")
    assert X.search_index(spark, path + "-none", "cat").count() == X.search_index(spark, path + "-none", "c").count() == 0


def snapshot(spark, files):
    return spark.createDataFrame(list(files.items()), "path string, hash string")


def stored_pair(spark, before, after):
    paths = []
    for files in (before, after):
        paths.append(scratch_path(spark, "snapshot"))
        SN.write_snapshot(snapshot(spark, files), paths[-1])
    return paths


def test_one_changed_file_opens_its_own_folders_only(spark):
    before = {f"p{i}/q{j}/r/{k}.md": f"h{i}{j}{k}" for i in range(5) for j in range(5) for k in range(3)} | {"top": "t"}
    after = before | {"p3/q2/r/1.md": "new"}
    paths = stored_pair(spark, before, after)
    changed = SN.changed_folders(spark, *paths)
    assert {r.folder: r.own for r in changed.collect()} == {"": False, "p3": False, "p3/q2": False, "p3/q2/r": True}
    assert rows(SN.stored_snapshot_diff(spark, *paths)) == [("p3/q2/r/1.md", "modified")]
    assert SN.stored_snapshot_diff(spark, paths[0], paths[0]).count() == 0


@pytest.mark.parametrize("few", [1_000, 0])
def test_stored_snapshots_differ_as_plain_ones(spark, monkeypatch, few):
    monkeypatch.setattr(SN, "FEW_FOLDERS", few)  # 0: folders are joined and not pushed down
    rng = random.Random(few)
    name = lambda: "/".join(rng.choice("ab") for _ in range(rng.randrange(5))) + rng.choice(["/x", "/y", "x"])
    for _ in range(2):
        before, after = ({name().lstrip("/"): rng.choice(["1", "2", None]) for _ in range(40)} for _ in range(2))
        after |= dict(list(before.items())[:20])
        want = rows(H.snapshot_diff(snapshot(spark, before), snapshot(spark, after)))
        assert rows(SN.stored_snapshot_diff(spark, *stored_pair(spark, before, after))) == want
    assert rows(SN.stored_snapshot_diff(spark, *stored_pair(spark, {}, {"a/b": "1"}))) == [("a/b", "added")]


def test_digests_of_folders(spark):
    files = {"a/x": "1", "a/b/y": "2", "z": None}
    got = {r.folder: (r.depth, r.parent, r.files, r.own_files) for r in SN.folder_digests(snapshot(spark, files)).collect()}
    assert got == {"": (0, None, 3, 1), "a": (1, "", 2, 1), "a/b": (2, "a", 1, 1)}
    assert SN.folder_digests(snapshot(spark, files)).select(F.count("x1")).first()[0] == 3
