"""Registered queries against their DuckDB statements, and the pipeline stage by stage."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import corpus_pipeline  # noqa: E402
from check import duck, rows_of  # noqa: E402
from docfleet.llm.queries import QUERIES, SQL  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(SQL))
def test_sql(spark, name):
    df = QUERIES[name](spark, SMALL)
    cur = duck(SMALL).execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cur.fetchall())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen.append({r.doc_id for r in docs.collect()})
    first, exact, near, mixed = seen
    assert first >= exact >= near >= mixed and len(mixed) > 50
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert pieces.filter("piece = 0").count() == docs.count()
    assert corpus_pipeline.run(spark, SMALL).filter("piece = 0").count() == docs.count()


@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_pipeline_on_odd_tables(spark, tmp_path, kind):
    """Nulls, empty and long texts, copies and near copies go through all stages; an empty table gives no pieces."""
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    near = [" ".join(f"w{i}" if i % 60 else f"x{k}" for i in range(120)) for k in range(3)]
    texts = [None, "", "same text here", "SAME text here", "long " * 9_000, *near, "é 日本", "\n\n"]
    rows = [(i, t, None, f"s{i % 2}" if i else None, 0) for i, t in enumerate(texts)] + [(2, "same text here", "en", "s0", 0)]
    docs = spark.createDataFrame(rows if kind == "odd" else [], columns)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 0, 0), (2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = {r.doc_id for r in pieces}
    if kind == "empty":
        assert not pieces
    else:
        assert kept <= {0, 1, 3, 4, 5, 8, 9} and {3, 4, 5} <= kept  # of copies the largest id, of near copies the smallest
        assert max(r.piece for r in pieces if r.doc_id == 4) >= 4
