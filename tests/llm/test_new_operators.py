"""Whitening, importance resampling and line dedup against brute force and on corner cases."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from docfleet.llm import importance, line_dedup, whitening
from docfleet.llm.queries import op11_incremental_whitening

SMALL = "/root/testdata/sf0.001"
ODD = "vec_id long, embedding array<double>, n string, whitened int, _x string"
DOCS = "doc_id long, text string, rank string, n_lines int, weight string"


# ---------------------------------------------------------------- whitening


def longs_of(vectors):
    return np.array([[math.floor(1024 * c) + 100_000 for c in v] for v in vectors], np.int64)


def check_whitened(rows, ids, x, k):
    n, d = x.shape
    sums = x.sum(0)
    apart = (n * x - sums) / n
    cov = apart.T @ apart / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert sorted((r.vec_id for r in rows), key=repr) == sorted(ids, key=repr)
    by_id = {r.vec_id: r for r in rows}
    expected = {i: sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for i, row in zip(ids, x)}
    got = np.array([by_id[i].whitened for i in ids], float)
    for i in ids:
        r = by_id[i]
        assert (r.n, int(r.deviation)) == (n, expected[i])
        assert np.allclose(r.explained, values[:k] / values.sum(), rtol=1e-9, atol=1e-15)
        assert r.identity_error < 1e-8
    for c in range(min(k, d)):
        if values[c] > 1e-9 * values.sum():
            plain = apart @ vectors[:, c] / math.sqrt(values[c])
            assert min(np.abs(got[:, c] - plain).max(), np.abs(got[:, c] + plain).max()) < 1e-7


@pytest.mark.parametrize("n, d, rank", [(300, 6, 6), (200, 64, 64), (40, 12, 3), (5, 9, 9)])
def test_rank_one_updates_give_the_scatter(n, d, rank):
    rng = np.random.default_rng(n)
    x = (rng.normal(size=(n, rank)) @ rng.normal(size=(rank, d)) * 500 + 1e5).astype(np.int64)
    x[: n // 3] = x[0]  # repeated rows
    one, two = whitening.Spectrum.empty(d), whitening.Spectrum.empty(d)
    one.add(x[: n // 2])
    two.add(x[n // 2 :])
    one.take(two)
    apart = x - x.mean(0)
    scatter = apart.T @ apart
    largest = np.abs(scatter).max()
    assert one.n == n and one.sums == x.sum(0).tolist() and np.allclose(one.mean, x.mean(0))
    assert np.abs(one.basis @ np.diag(one.roots) @ one.basis.T - scatter).max() < 1e-11 * largest
    assert np.abs(one.basis.T @ one.basis - np.eye(d)).max() < 1e-11


def test_secular_roots():
    rng = np.random.default_rng(3)
    for k in (2, 3, 17):
        for power in range(-6, 3):
            d, z = np.sort(rng.uniform(0, 100, k)), rng.normal(size=k) * 10.0**power
            roots, _ = whitening.secular_roots(d, z)
            assert np.abs(roots - np.linalg.eigvalsh(np.diag(d) + np.outer(z, z))).max() < 1e-12 * roots[-1]


def test_whiten(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS_PER_TASK", 25)  # so that a tree is needed
    rng = np.random.default_rng(1)
    base = (rng.normal(size=(300, 10)) * np.geomspace(1, 0.02, 10)).tolist()
    base[20:60] = [base[20]] * 40
    rows = [(i, v, "n", 1, "x") for i, v in enumerate(base)]
    bad = [(900, None, None, None, None), (901, [1.0, None] * 5, None, None, None), (902, [float("nan")] * 10, None, None, None), (903, [float("inf")] + [0.0] * 9, None, None, None), (904, [], None, None, None)]
    got = whitening.whiten(spark.createDataFrame(rows + bad, ODD).repartition(3)).collect()
    check_whitened(got, list(range(300)), longs_of(base), 8)


def test_whiten_odd_lists(spark):
    rng = np.random.default_rng(2)
    flat = [(i, [0.5, -0.25, 3.0], "", 0, "") for i in range(4)]
    pairs = [(10 + i, rng.normal(size=2).tolist(), "", 0, "") for i in range(30)]
    huge = [(50, [1e300, -1e300, 0.0, 1.0], "", 0, ""), (51, [0.0, 1.0, 2.0, 3.0], "", 0, "")]
    got = {r.vec_id: r for r in whitening.whiten(spark.createDataFrame(flat + pairs + huge + [(None, [1.0], "", 0, "")], ODD)).collect()}
    assert all(got[i].whitened == [None] * 3 and got[i].deviation == 0 and got[i].identity_error == 0 for i in range(4))
    assert got[None].whitened == [None] and got[None].n == 1
    check_whitened([got[10 + i] for i in range(30)], [10 + i for i in range(30)], longs_of([r[1] for r in pairs]), 2)
    assert got[50].whitened[0] == pytest.approx(-got[51].whitened[0]) and abs(got[50].whitened[0]) == pytest.approx(1) and got[50].whitened[2] is None
    assert whitening.whiten(spark.createDataFrame([], ODD)).count() == 0


def test_whitening_query(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    rows = op11_incremental_whitening(spark, SMALL).collect()
    assert len(rows) == 8 * len(table)
    grouped = defaultdict(list)
    for r in rows:
        grouped[r.vec_id].append(r)

    class Row:
        def __init__(self, own):
            own = sorted(own, key=lambda r: r.component)
            self.vec_id, self.n, self.deviation, self.identity_error = own[0].vec_id, own[0].n, own[0].deviation, own[0].identity_error
            self.whitened, self.explained = [r.whitened for r in own], [r.explained for r in own]
            assert [r.component for r in own] == list(range(1, 9)) and len({(r.n, r.deviation, r.identity_error) for r in own}) == 1

    check_whitened([Row(own) for own in grouped.values()], [r.vec_id for r in table], longs_of([[float(c) for c in r.embedding] for r in table]), 8)


# ---------------------------------------------------------------- importance resampling


def features(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def buckets(text):
    return [zlib.crc32(f.encode()) % 10_000 for f in features(text)[1]]


def brute_resample(rows, target):
    raw, wanted = Counter(b for _, t in rows for b in buckets(t)), Counter(b for t in target for b in buckets(t))
    s, t = sum(raw.values()), sum(wanted.values())
    out = []
    for doc_id, text in rows:
        own = buckets(text)
        weight = sum(math.floor(1000 * math.log((wanted[b] + 1) * (s + 10_000) / ((raw[b] + 1) * (t + 10_000)))) for b in own)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(features(text)[0]), len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], -1 if r[0] is None else r[0], r[3], r[2]))
    for k, r in enumerate(able[: len(able) * 5 // 100]):
        r[5] = k + 1
    return sorted(((r[0], r[2], r[3], r[4], r[5]) for r in out), key=repr)


def result_of(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=repr)


def test_crcs_of_every_length():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 5_000, dtype=np.uint8)
    start, length = rng.integers(0, 4_000, 3_000), np.concatenate([rng.integers(1, 30, 2_900), rng.integers(1, 900, 100)])
    raw = data.tobytes()
    assert importance.crcs(data, start, length).tolist() == [zlib.crc32(raw[a : a + n]) for a, n in zip(start.tolist(), length.tolist())]


@pytest.mark.parametrize("block", [1 << 21, 200])  # the second cuts long texts into pieces
def test_importance_resampling(spark, monkeypatch, block):
    monkeypatch.setattr(importance, "BLOCK_BYTES", block)
    words = [f"w{i}" for i in range(60)] + ["É", "日本", "x9"]
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(words, int(n))) for n in rng.integers(0, 120, 150)]
    texts += [None, "", "...", "One", "ONE two", "a-b_c d\x00e\x85f\xa0g", "y" * 3_000, "word " * 2_000, " --\n" * 500]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[5]), (None, texts[8])]
    target = [" ".join(words[:20]), None, "É 日本 w1"]
    docs = spark.createDataFrame([(i, t, "r", 1, "w") for i, t in rows], DOCS).repartition(3)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.draw(importance.score_documents(docs, wanted))
    assert result_of(got) == brute_resample(rows, target)
    drawn = importance.resample(docs, wanted, percent=20)
    assert drawn.columns == docs.columns and drawn.count() >= 20
    for empty in (docs.limit(0), docs):
        nothing = importance.draw(importance.score_documents(empty, wanted.limit(0)))
        assert result_of(nothing) == brute_resample(rows if empty is docs else [], [])


# ---------------------------------------------------------------- line dedup


def brute_lines(rows, min_documents=3):
    blank = " \t\n\x0b\x0c\r"
    key = lambda line: line.strip(blank).translate({c: c + 32 for c in range(65, 91)})
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(-1 if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 20 or len(holders[key(x)]) < min_documents or max(holders[key(x)]) == (-1 if i is None else i)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def lines_of(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()), key=repr)


def test_line_dedup_on_odd_rows(spark):
    common, other = "This line stands in many documents", "Another line that is often repeated é"
    short, nineteen, twenty = "short line", "a" * 19, "é" * 20
    texts = [
        None, "", "\n", common, f"{common}\n{common}", f"  {common.upper()}\t\r\nx\n{other}\n", f"{other}\n\n{other}\n{short}", f"{short}\n{nineteen}\n{twenty}",
        f"\n{twenty} \n{nineteen}", f"{short}\n\x0b{twenty}\x0c\n{nineteen}\n{other.replace('é', 'É')}", f" {common}\n{other}", "\n".join(f"row number {i} of a long text" for i in range(3_000)),
        "\n".join(f"row number {i} of a long text" for i in range(0, 6_000, 2)), "\n".join(f"row number {i} of a long text" for i in range(0, 6_000, 3)),
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(4, texts[4]), (4, other), (None, f"{common}\nq"), (None, twenty), (None, None)]
    docs = spark.createDataFrame([(i, t, "r", 7, "w") for i, t in rows], DOCS).repartition(3)
    got = line_dedup.drop_shared_lines(docs)
    assert lines_of(got) == brute_lines(rows)
    assert sorted(got.columns) == ["doc_id", "n_dropped", "n_lines", "rank", "text", "weight"] and {r["rank"] for r in got.collect()} == {"r"}
    assert lines_of(line_dedup.drop_shared_lines(docs, min_documents=2)) == brute_lines(rows, 2)
    assert line_dedup.drop_shared_lines(docs.limit(0)).count() == 0


def test_line_dedup_has_no_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = line_dedup.drop_shared_lines(docs)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    expected = brute_lines([(r.doc_id, r.text) for r in docs.collect()])
    assert lines_of(got) == expected and sum(r[3] for r in expected) > 0
