"""Heavy keys and long groups: results must not depend on how the work is cut."""

import itertools
import random

import pytest
from pyspark.sql import Window, functions as F

from docfleet.operators import documents as D
from docfleet.operators import history as H
from docfleet.operators import hygiene
from docfleet.operators import similarity as N
from docfleet.operators import status as S
from docfleet.plans import ordered as O
from docfleet.plans.runtime import Folder, scratch_path, spread_out


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def skewed(spark):
    # key 1 holds two thirds of the rows; some keys are null
    data = [(1 if i % 3 else (None if i % 9 == 0 else i), i, i % 7) for i in range(200)]
    return spark.createDataFrame(data, "k int, id int, v int")


def test_running_sum_by_position(spark, tight, skewed):
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumn("s", F.sum("v").over(w)).filter("k is not null")
    got = O.running_sum_by_position(skewed.filter("k is not null"), ["k"], "id", F.col("v"), "s")
    assert rows(got.select("k", "id", "v", "s")) == rows(want)


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_number_rows_any_cut(spark, skewed, parts):
    order = [F.col("v").desc(), F.col("id")]
    want = skewed.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order)).cast("bigint"))
    assert rows(O.number_rows(skewed, ["k"], order, parts=parts)) == rows(want)


def test_with_neighbours(spark, tight):
    df = spark.createDataFrame([(d, p, f"{d}-{p}") for d in (1, 2) for p in range(11)], "d int, p bigint, t string")
    got = {(r.d, r.p): (r.a, r.b) for r in O.with_neighbours(df, ["d"], "p", {"a": ("t", -1), "b": ("t", 1)}).collect()}
    assert len(got) == 22
    for (d, p), (a, b) in got.items():
        assert a == (f"{d}-{p - 1}" if p else None) and b == (f"{d}-{p + 1}" if p < 10 else None)


def test_long_text_comes_in_parts_that_join_to_the_whole(spark, tight):
    pages = spark.createDataFrame([(7, p, f"text {p}") for p in range(1, 12)], "doc_id int, page bigint, text string")
    got = D.assemble_pages(pages).orderBy("part").collect()
    assert [r.part for r in got] == [0, 1, 2]
    assert "\n".join(r.text for r in got) == "\n".join(f"--- Page {p} ---\n\ntext {p}" for p in range(1, 12))


def test_explode_range_in_stretches(spark, tight):
    df = spark.createDataFrame([(1, 2, 12), (2, 5, 5), (3, 4, 3)], "k int, lo bigint, hi bigint")
    got = rows(O.explode_range(df, ["k"], "lo", "hi", "x").select("k", "x"))
    assert got == sorted([(1, x) for x in range(2, 13)] + [(2, 5)], key=repr)


def test_state_as_of_with_one_busy_project(spark):
    random.seed(1)
    history = [(1 if i % 3 else 2, i // 2, i, f"p{i}") for i in range(90)]
    points = [(random.choice([1, 2, 3]), t) for t in range(-1, 50)]
    h = spark.createDataFrame(history, "project_id int, s int, seq bigint, phase string").withColumn("ts", F.timestamp_seconds("s"))
    p = spark.createDataFrame(points, "project_id int, s int").withColumn("at", F.timestamp_seconds("s"))
    got = {(r.project_id, r.s): r.phase for r in H.state_as_of(p, h, ["phase"]).select("project_id", F.unix_seconds("at").alias("s"), "phase").collect()}
    for project, t in points:
        best = max((e for e in history if e[0] == project and e[1] <= t), key=lambda e: (e[1], e[2]), default=None)
        assert got[(project, t)] == (best[3] if best else None)


def test_versions_across_pieces(spark):
    data = [("a", i, "xyyxx"[i % 5]) for i in range(40)] + [("b", 1, "x")]
    df = spark.createDataFrame(data, "path string, ts int, hash string").withColumn("ts", F.timestamp_seconds("ts"))
    got = {(r.path, r.t): r.version for r in H.content_versions(df).select("path", F.unix_seconds("ts").alias("t"), "version").collect()}
    version, before = 0, None
    for _, t, h in data[:40]:
        version += h != before
        before = h
        assert got[("a", t)] == version
    assert got[("b", 1)] == 1


def test_batch_progress_of_one_large_batch(spark, tight):
    items = spark.createDataFrame([(1, i, "success") for i in range(100)], "batch_id int, idx bigint, status string")
    got = {r.position: r.progress for r in S.batch_progress(items).collect()}
    assert got == {n: int(n / 100 * 100) for n in range(1, 101)}
    assert got[29] == 28


def test_page_selection_of_a_long_document(spark, tight):
    pages = spark.createDataFrame([(1, p, f"t{p}") for p in range(1, 21)], "doc_id int, page bigint, text string")
    asked = spark.createDataFrame([(i, 1, ["3-17", "2", "19-40"]) for i in range(9)], "request_id int, doc_id int, ranges array<string>")
    want = [*range(3, 18), 2, 19, 20]
    got = D.select_pages(pages, asked).collect()
    for i in range(9):
        assert [r.page for r in sorted((r for r in got if r.request_id == i), key=lambda r: r.out_page)] == want
        assert sorted(r.out_page for r in got if r.request_id == i) == list(range(1, len(want) + 1))


def test_selecting_everything_and_merging_gives_the_documents(spark, tight):
    pages = spark.createDataFrame([(d, p, f"{d}.{p}") for d in (1, 2, 3) for p in range(1, 4 + d)], "doc_id int, page bigint, text string")
    all_pages = spark.createDataFrame([(d, d, ["1-99"]) for d in (1, 2, 3)], "request_id int, doc_id int, ranges array<string>")
    same = D.select_pages(pages, all_pages)
    assert rows(same.select("request_id", "out_page", "text")) == rows(pages)
    order = spark.createDataFrame([(9, i, d) for i, d in enumerate((3, 1, 3, 2))], "merge_id int, pos bigint, doc_id int")
    merged = D.merge_documents(pages, order).orderBy("out_page").collect()
    texts = [f"{d}.{p}" for d in (3, 1, 3, 2) for p in range(1, 4 + d)]
    assert [r.text for r in merged] == texts and [r.out_page for r in merged] == list(range(1, len(texts) + 1))


def test_copies_of_one_content(spark, tight):
    files = spark.createDataFrame([(f"f{i:02}", 3, "same" if i % 3 else f"own{i}", i % 4) for i in range(30)], "path string, size bigint, content string, m int")
    digests = hygiene.file_digests(files.withColumn("mtime", F.timestamp_seconds("m")))
    kept = [r for r in hygiene.duplicate_keeper(digests).collect()]
    same = [i for i in range(30) if i % 3]
    assert len(kept) == len(same)
    best = min(same, key=lambda i: (-(i % 4), i))
    assert {r.keeper for r in kept} == {f"f{best:02}"} and [r.path for r in kept if r.kept] == [f"f{best:02}"]


# ---------------------------------------------------------------- near duplicates


def brute_clusters(docs, threshold=0.8, words=5):
    sets = {}
    for i, text in docs:
        w = text.lower().split()
        if w:
            sets[i] = {tuple(w[j : j + words]) for j in range(max(1, len(w) - words + 1))}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both / (len(sets[a]) + len(sets[b]) - both) > threshold:
            x, y = root(a), root(b)
            label[max(x, y)] = min(x, y)
    groups = {}
    for i in sets:
        groups.setdefault(root(i), []).append(i)
    return {i: k for k, g in groups.items() if len(g) > 1 for i in g}


def family(seed, n_docs, n_words, edits, vocabulary=60):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(vocabulary)}" for _ in range(n_words)]
    out = []
    for _ in range(n_docs):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(n_words)] = f"x{rng.randrange(9)}"
        out.append(" ".join(text))
        base = text if rng.random() < 0.5 else base  # chains drift away from the first text
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_near_duplicates_equal_brute_force(spark, tight, seed):
    texts = family(seed, 40, 60, 2) + family(seed + 50, 25, 30, 1) + ["one two three", "a b c d e", "a b c d e"]
    rng = random.Random(seed)
    texts += [" ".join(f"w{rng.randrange(60)}" for _ in range(40)) for _ in range(20)]
    docs = list(enumerate(texts))
    got = N.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert {r.doc_id: r.cluster_id for r in got.collect()} == brute_clusters(docs)


@pytest.mark.parametrize("most", [0, 2_000_000])
def test_near_duplicates_with_copies_by_broadcast_and_by_shuffle(spark, monkeypatch, most):
    monkeypatch.setattr(N, "BROADCAST_IDS", most)
    texts = family(7, 30, 50, 2)
    docs = [(len(texts) * 3 - i, t) for i, t in enumerate(texts + texts + texts[:9])] + [(500, ""), (501, None), (502, "one two")]
    got = N.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert {r.doc_id: r.cluster_id for r in got.collect()} == brute_clusters([(i, t or "") for i, t in docs])


def test_near_duplicates_leave_no_shingles_behind(spark):
    """Shingles take more room than the texts: one stored copy, which goes when the clusters are known."""
    base = Folder(spark, scratch_path(spark, "any").rsplit("/", 1)[0])
    before = set(base.names())
    got = N.near_duplicates(spark.createDataFrame(list(enumerate(family(8, 30, 50, 2))), "doc_id bigint, text string"))
    left = [n for n in set(base.names()) - before if "tokens" in spark.read.parquet(f"{base.path}/{n}").columns or n.startswith("shared-")]
    assert got.count() > 0 and left == []


def test_counting_splits_runs_nothing(spark):
    """The shuffles of a join were run once to count its splits and once more for the result."""
    one = spark.range(1000).withColumn("v", F.rand(1)).hint("merge")
    both = one.join(spark.range(1000), "id")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup()
    spread_out(both)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == jobs


def test_residual_pairs_are_needed_and_found(spark):
    # a chain: neighbours are similar, the ends are not, and the pivot sees only its own end
    words = [f"w{i}" for i in range(60)]
    docs = [(k, " ".join(words[k * 2 : k * 2 + 40])) for k in range(10)]
    got = N.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert {r.doc_id: r.cluster_id for r in got.collect()} == brute_clusters(docs) == {k: 0 for k in range(10)}


def test_texts_that_share_most_shingles_are_hardly_paired(spark, monkeypatch):
    """Form letters: three quarters of the shingles are common to all, the rest is each text's own."""
    seen = []
    pair = N._pair

    def counted(tried):
        seen.append(tried.count())
        return pair(tried)

    monkeypatch.setattr(N, "_pair", counted)
    letter = lambda i: " ".join(f"own{i}-{j}" if j % 17 == 5 else f"w{j}" for j in range(120))
    for n in (200, 1600):
        docs = [(i, letter(i)) for i in range(n)] + [(n, letter(0) + " end")]
        got = N.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"))
        assert {r.doc_id for r in got.collect()} == {0, n}
    assert sum(seen) <= 40  # pairs looked at, for 200 and 1,600 texts together


def test_similar_names_equal_brute_force(spark):
    rng = random.Random(5)
    names = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))) for _ in range(60)})
    files = spark.createDataFrame([(f"d/{n}.md",) for n in names] + [("e/abc.md",), ("README",), ("READM",)], "path string")

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    for k in (1, 2, 3):
        want = sorted((f"d/{a}.md", f"d/{b}.md", n) for a, b in itertools.combinations(names, 2) if (n := distance(a, b)) <= k)
        got = [tuple(r) for r in N.similar_names(files, k).collect()]
        assert sorted((a, b, n) for f, _, a, b, n in got if f == "d") == want
        assert [g for g in got if g[0] == ""] == [("", "", "READM", "README", 1)]


def test_similar_names_of_any_length_and_case(spark):
    rng = random.Random(9)
    stems = ["".join(rng.choice("ab") for _ in range(rng.randrange(0, 14))) for _ in range(120)]
    paths = sorted({f"x/{''.join(c.upper() if rng.random() < 0.2 else c for c in s)}.{rng.choice(['md', 'MD'])}" for s in stems})
    low = {p: p[2:-3].lower() for p in paths}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    files = spark.createDataFrame([(p,) for p in paths + paths[:5]], "path string")
    for k in (1, 2, 3):
        want = sorted((a, b, n) for a, b in itertools.combinations(paths, 2) if (n := distance(low[a], low[b])) <= k)
        assert sorted((r.path_a, r.path_b, r.distance) for r in N.similar_names(files, k).collect()) == want
        assert any(n == 0 for _, _, n in want)


def rows_of_joins(df):
    """The rows that the joins of a DataFrame have made, after it was collected."""
    total, queue = 0, [df._jdf.queryExecution().executedPlan()]
    while queue:
        node = queue.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            queue.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            queue.append(node.plan())
        if kind.endswith("JoinExec"):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        queue += [children.apply(i) for i in range(children.size())]
    return total


def test_names_that_share_a_part_are_not_paired(spark):
    """Every stem ends alike, so all of them share segments; only those that are close may meet."""
    rng = random.Random(3)
    stems = sorted({"".join(rng.choice("abcdefghijklmnop") for _ in range(4)) for _ in range(400)})
    close = sum(sum(x != y for x, y in zip(a, b)) <= 2 for a, b in itertools.combinations(stems, 2))
    got = N.similar_names(spark.createDataFrame([(f"d/{s}-report.md",) for s in stems], "path string"), 2)
    pairs = len(got.collect())
    assert pairs >= close > 100
    assert rows_of_joins(got) <= 2 * pairs  # the segments alone join more than all pairs of names


def test_similar_names_at_the_limit_of_forms(spark, monkeypatch):
    """Some pairs are found by their forms, some by segments, some have a name on either side; holes are in a name."""
    rng = random.Random(4)
    stems = sorted({"".join(rng.choice("ab" + N.HOLE) for _ in range(rng.randrange(0, 9))) for _ in range(90)})
    files = spark.createDataFrame([(f"{i % 3}/{s}.md",) for i, s in enumerate(stems)] + [(None,)], "path string")
    want = None
    for most, in_slice in ((0, 10**6), (30, 10**6), (60, 500), (10**6, 500), (10**6, 10**6)):
        monkeypatch.setattr(N, "MOST_FORMS", most)
        monkeypatch.setattr(N, "FORMS_PER_SLICE", in_slice)
        got = rows(N.similar_names(files, 2))
        assert len(got) == len(set(got)) and got == (want := want or got)


def test_labels_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(70) if i != 40], "a bigint, b bigint")
    got = {r.id: r.label for r in N.connected_labels(edges).collect()}
    assert got == {i: 0 if i <= 40 else 41 for i in range(71)}
