"""Small hand-written tables for the corner cases of every operator family."""

import hashlib
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docfleet.functions import constants as K
from docfleet.functions import markdown as M
from docfleet.functions import scalars as P
from docfleet.operators import convert as C
from docfleet.operators import documents as D
from docfleet.operators import history as H
from docfleet.operators import hygiene as G
from docfleet.operators import lookup as L
from docfleet.operators import status as S
from docfleet.sources import files as SF
from docfleet.sources import state as ST


def apply(spark, values, schema, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {schema}")
    return [r.y for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def now(spark=None):
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def hours_ago(h):
    return now() - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(h * 3600))


# ---------------------------------------------------------------- scalars


def test_extension(spark):
    assert apply(spark, ["a", "a.", ".md", "A.B.PDF", ""], "string", P.file_extension) == ["", "", "md", "pdf", ""]


def test_result_name(spark):
    got = apply(spark, ["a", "a.", ".md", "A.B.PDF", ""], "string", lambda c: P.result_name(c, F.lit("word")))
    assert got == ["a_converted.docx", "a._converted.docx", "_converted.docx", "A.B_converted.docx", "file_converted.docx"]


def test_human_size(spark):
    sizes = [0, 1, 1023, 1024, 1536, 1152, 1048575, 1048576, 1099511627776, 5 * 1024**4]
    want = ["0 B", "1 B", "1023 B", "1 KB", "1.5 KB", "1.13 KB", "1024 KB", "1 MB", "1024 GB", "5120 GB"]
    assert apply(spark, sizes, "bigint", P.human_size) == want


def test_download_names_fixed_and_as_before(spark):
    kinds = ["pdf_to_word", "pdf_to_html", "excel_to_csv", "png_to_ico", "svg_to_png", "pdf_to_images"]
    fmt = lambda c: P.output_format(c)
    strict = apply(spark, kinds, "string", lambda c: P.download_name(P.content_type(fmt(c))))
    loose = apply(spark, kinds, "string", lambda c: P.download_name(P.content_type(fmt(c), False), False))
    assert strict == [f"converted.{e}" for e in ("docx", "html", "csv", "ico", "png", "png")]
    assert loose == [f"converted.{e}" for e in ("pdf", "pdf", "pdf", "pdf", "png", "pdf")]


def test_signature(spark):
    df = spark.createDataFrame(
        [(b"", "txt"), (b"PK\x03\x04..", "docx"), (b"PK", "xlsx"), (b"\x89PNG\r\n", "png"), (b"GIF", "png"), (b"x", "pdf")],
        "c binary, e string",
    )
    assert [r[0] for r in df.select(P.sniff_signature(F.col("c"), F.col("e"))).collect()] == [False, True, False, True, False, True]


def test_category_takes_the_first_substring(spark):
    texts = ["High performance", "API form", "Login page", "Authentic", "Other", "an ENDPOINT"]
    assert apply(spark, texts, "string", P.task_category) == ["form", "api", "auth", "auth", "generic", "api"]


def test_artifact_names(spark):
    names = ["02a-architecture-overview.md", "03b-sprint-1-core-api.md", "2a-x.md", "02a-X.md", "02a-.md", "02a-a--b.md", "02-a.json", "02-a.md\n"]
    assert apply(spark, names, "string", P.valid_artifact_name) == [True, True, False, False, False, False, True, False]


def test_strip_is_unicode_wide(spark):
    texts = ["　 a b  \n", "\x1c\x85", "", "a"]
    assert apply(spark, texts, "string", P.strip) == [t.strip() for t in texts]
    assert apply(spark, texts, "string", P.is_blank) == [not t.strip() for t in texts]


def test_the_forms_of_white_space_agree(spark):
    chars = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    assert sorted(K.BLANK_CHARS) == chars
    df = spark.range(0x3100).filter("id > 0").select("id", F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'utf-16be')").alias("c"))
    runs = df.filter(F.col("c").rlike(rf"^{K.BLANK_RUN}\z") | F.col("c").rlike(rf"^[{K.BLANKS}]\z"))
    both = df.filter(F.col("c").rlike(rf"^{K.BLANK_RUN}\z") & F.col("c").rlike(rf"^[{K.BLANKS}]\z"))
    assert [r.id for r in runs.orderBy("id").collect()] == [r.id for r in both.orderBy("id").collect()] == [ord(c) for c in chars]


def test_time_ago_and_stale(spark):
    df = spark.range(1).select(*[P.time_ago(hours_ago(h), now()).alias(str(i)) for i, h in enumerate((0, 0.5, 2, 30, 72))])
    assert list(df.first()) == ["just now", "30 minutes ago", "2 hours ago", "yesterday", "3 days ago"]
    assert list(spark.range(1).select(P.is_stale(hours_ago(168), now()), P.is_stale(hours_ago(167), now())).first()) == [True, False]


# ---------------------------------------------------------------- documents


def test_page_ranges(spark):
    pages = spark.createDataFrame([(1, p, f"t{p}") for p in range(1, 5)], "doc_id int, page bigint, text string")
    asked = [["3-4", "1", "1"], ["2-99"], ["5-2"], ["0"], ["a"], ["1-2-3"], [" 2 "], ["-3"], ["1 - 2"], [], ["1", "x"], ["9"]]
    requests = spark.createDataFrame([(i, 1, r) for i, r in enumerate(asked)], "request_id int, doc_id int, ranges array<string>")
    got = {}
    for r in D.select_pages(pages, requests).orderBy("out_page").collect():
        got.setdefault(r.request_id, []).append(r.page)
    assert got == {0: [3, 4, 1, 1], 1: [2, 3, 4], 6: [2], 8: [1, 2]}
    state = {r.request_id: r.status for r in D.check_page_ranges(requests).collect()}
    assert [i for i, s in state.items() if s == "failure"] == [4, 5, 7, 10]


MD = ["#x", "####### y", "# ", "- a", "* b", "-c", "", "```py", "# inside", "```", "after", "``` again", "- code"]


def md_lines(spark):
    return spark.createDataFrame([(1, i, t) for i, t in enumerate(MD)], "doc_id int, pos bigint, line string")


def test_classify_markdown(spark):
    got = [(r.kind, r.level, r.text) for r in D.classify_markdown(md_lines(spark)).orderBy("pos").collect()]
    assert got == [
        ("heading", 1, "x"), ("heading", 6, "y"), ("heading", 1, ""), ("bullet", None, "- a"), ("bullet", None, "* b"),
        ("paragraph", None, "-c"), ("paragraph", None, ""), ("code", None, "# inside"), ("paragraph", None, "after"), ("code", None, "- code"),
    ]


def test_whole_text_gives_the_same_blocks_and_html(spark):
    lines = md_lines(spark)
    text = spark.createDataFrame([("\n".join(MD),)], "t string")
    blocks = text.select(F.explode(M.text_to_blocks(F.col("t"))).alias("b")).select("b.*").collect()
    assert [tuple(b) for b in blocks] == [(r.kind, r.level, r.text) for r in D.classify_markdown(lines).orderBy("pos").collect()]
    html = text.select(M.text_to_html(F.col("t"))).first()[0]
    assert html == D.render_html(lines).first().html
    assert html.startswith("<h1>x</h1>\n<h6>y</h6>\n<h1></h1>\n<ul>\n<li>a</li>\n<li>b</li>\n</ul>\n<p>-c</p>\n<pre><code>\n# inside\n</code></pre>")
    assert html.endswith("<p>after</p>\n<pre><code>\n- code\n</code></pre>")


@pytest.mark.parametrize("text", ["", "a", "```", "\n\n", "```\n```\n```\nx", "<b> & c", "#\n#a\n\n- x\ny", "a```\n``` b\n c", "- \n* ", "  # no\n\t"])
def test_html_of_text_equals_html_of_lines(spark, text):
    lines = spark.createDataFrame([(1, i, t) for i, t in enumerate(text.split("\n"))], "doc_id int, pos bigint, line string")
    row = D.render_html(lines).first()
    html = spark.createDataFrame([(text,)], "t string").select(M.text_to_html(F.col("t"))).first()[0]
    assert html == (row.html if row else "")


def test_render_markdown(spark):
    data = [(1, 0, "Heading 1", "a"), (1, 1, "heading", "b"), (1, 2, "Normal", "c"), (2, 0, "TOC Heading", "d"), (2, 1, "Normal", "e"), (3, 0, "Heading 0", "f")]
    blocks = spark.createDataFrame(data, "doc_id int, pos bigint, style string, text string")
    got = {r.doc_id: (r.markdown, r.error) for r in D.render_markdown(blocks).collect()}
    assert got[1] == ("# a\n\n# b\n\nc\n", None)
    assert got[2] == (None, "invalid heading level: toc")
    assert got[3] == (" f\n", None)


def test_headings_round_trip(spark):
    data = [(1, i, f"Heading {i + 1}", f"title {i}") for i in range(6)]
    blocks = spark.createDataFrame(data, "doc_id int, pos bigint, style string, text string")
    text = D.render_markdown(blocks).first().markdown
    lines = spark.createDataFrame([(1, i, t) for i, t in enumerate(text.split("\n"))], "doc_id int, pos bigint, line string")
    back = D.classify_markdown(lines).filter("kind = 'heading'").orderBy("pos").collect()
    assert [(b.level, b.text) for b in back] == [(i + 1, f"title {i}") for i in range(6)]


def test_cells_blank_or_kept(spark):
    values = [(None, True), ("0", True), ("0.0", True), ("false", True), ("", False), ("0", False), ("a,b", False), ('q"', False)]
    cells = spark.createDataFrame([(1, 1, i, v, n) for i, (v, n) in enumerate(values)], "doc_id int, rw bigint, col int, value string, is_num boolean")
    assert SF.csv_lines(cells).first().line == ',,,,,0,a,b,q"'
    assert SF.csv_lines(cells, quote=True).first().line == ',,,,,0,"a,b","q"""'
    assert D.sheet_rows(cells).first()["values"] == ["", "0", "0.0", "false", "", "0", "a,b", 'q"']
    assert D.sheet_rows(cells.withColumn("rw", F.lit(0).cast("bigint"))).count() == 0


def test_used_range_past_column_26(spark):
    cells = spark.createDataFrame([(1, 2, 1, "x"), (1, 4, 30, "y"), (1, 9, 40, None)], "doc_id int, rw bigint, col int, value string")
    widths = spark.createDataFrame([(1, 0, 20.0), (1, 30, 0.0), (1, 40, 99.0)], "doc_id int, col int, width double")
    assert tuple(D.sheet_used_range(cells, widths).first()) == (1, 3, 5, 2, 31, 31 * 8 + 12.0)
    assert D.sheet_used_range(cells).first().total_width == 31 * 8.0


def test_page_quality(spark):
    data = [(1, n * 2 + k, " " + "x" * length + "\n", k) for n, length in enumerate((0, 9, 10, 49, 50)) for k in (0, 1)]
    got = [r.issues for r in D.page_quality(spark.createDataFrame(data, "doc_id int, page int, text string, images int")).orderBy("page").collect()]
    little, empty = "Very little text content", "May be empty or have rendering issues"
    assert got == [[little, empty], [little], [little, empty], [little], [empty], [], [empty], [], [], []]


def test_globs(spark):
    paths = ["a/x.py", "b.py/y.js", "x1.py", "z.PY", "a/b/[q].md"]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    find = lambda g: [r.path for r in D.list_matching(files, g).collect()]
    assert find("*.py") == ["a/x.py", "x1.py"] and find("?.py") == ["a/x.py"] and find("x[0-9].py") == ["x1.py"]
    assert find("*[!y]") == ["a/b/[q].md", "b.py/y.js", "z.PY"] and len(find("*")) == 5


def test_features_of_a_requirement(spark):
    req = spark.createDataFrame([(1, "api", "a\n\n  b \n"), (2, "webapp", "\n".join(f"f{i}" for i in range(60)))], "project_id int, type string, description string")
    got = D.explode_features(req).orderBy("project_id", "pos").collect()
    one = [r for r in got if r.project_id == 1]
    assert len(one) == 15 and one[0].description.startswith("REST") and [r.description for r in one[13:]] == ["a", "b"]
    assert len([r for r in got if r.project_id == 2]) == 70 and not any(r.passes for r in got)


# ---------------------------------------------------------------- sources


def test_requirement_files(spark):
    items = [
        {"name": "a", "priority": 5}, {"name": "b", "priority": "7"}, {"name": "c", "priority": "2.5"}, {"name": "d", "priority": 2.9},
        {"name": "e", "priority": True}, {"name": "f", "priority": None}, {"name": "g", "description": "text"}, {"priority": -3},
    ]
    texts = spark.createDataFrame(
        [("in/list.json", json.dumps(items)), ("in/one.json", json.dumps({"name": "solo"})), ("in/plain.v1.txt", "build it"), ("in/bad.json", '{"name": "x"')],
        "path string, content string",
    )
    got = [tuple(r)[2:] for r in ST.read_requirements(texts).orderBy("path", "pos").collect()]
    assert got == [
        ("bad", '{"name": "x"', 1), ("a", "a", 5), ("b", "b", 7), ("c", "c", 1), ("d", "d", 2), ("e", "e", 1), ("f", "f", 1), ("g", "text", 1),
        ("Unnamed Project", "", -3), ("solo", "solo", 1), ("plain.v1", "build it", 1),
    ]


def test_inventory_of_a_folder(spark, tmp_path):
    root = tmp_path / "tree"
    for name in ("a.txt", "sub/b.md", "node_modules/c.js", "sub/.git/d", "frontend/dist/e.js", "venv_not/f", "skip.py", "sub/.env", "_x/y z"):
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x" if name != "sub/b.md" else "")
    found = SF.scan_files(spark, str(root), skip=["skip.py"])
    assert sorted((r.path, r.size) for r in found.collect()) == [
        ("_x/y z", 1), ("a.txt", 1), ("frontend/dist/e.js", 1), ("sub/.env", 1), ("sub/b.md", 0), ("venv_not/f", 1),
    ]
    # equal contents, and a lone size that need not be read
    (root / "lone.bin").write_bytes(b"12345")
    digests = SF.hash_files(SF.scan_files(spark, str(root), skip=["skip.py"]), str(root))
    assert digests.count() == 5
    groups = G.duplicate_groups(digests).collect()
    assert {r.hash for r in groups} == {hashlib.sha256(b"x").hexdigest()} and len(groups) == 5
    assert SF.hash_files(found, str(root), copies_only=False).count() == 5
    texts = ST.read_texts(spark, str(root), "*.txt")
    assert [(r.path.split("/")[-1], r.content) for r in texts.collect()] == [("a.txt", "x")]
    manifest = SF.ingest_manifest(found)
    assert manifest.select("file_id").distinct().count() == 6
    assert sorted(r.file_id for r in manifest.collect()) == sorted(r.file_id for r in SF.ingest_manifest(found).collect())


def test_results_expire_after_a_day(spark, tmp_path):
    rows = spark.range(5).select("id", hours_ago(1).alias("created_at"), F.lit("success").alias("status")).withColumn(
        "created_at", F.expr("created_at - make_dt_interval(0, int(id) * 12)")
    )
    SF.write_results(rows, str(tmp_path / "r"))
    assert sorted(r.id for r in SF.read_results(spark, str(tmp_path / "r"), now()).collect()) == [0, 1]


def test_broken_state_is_told_apart(spark):
    good = '{"project-id": "p", "phases": [{"id": "01", "status": "completed"}]}'
    docs = spark.createDataFrame([(1, good), (2, '{"project-id": "p" "name": 1}'), (3, "")], "id int, doc string")
    got = {r.id: (r.broken, r.state and r.state["project-id"]) for r in ST.read_state_json(docs, ST.MANIFEST).collect()}
    assert got == {1: (False, "p"), 2: (True, None), 3: (True, None)}
    assert [r.id for r in ST.broken_state(docs, ST.MANIFEST).orderBy("id").collect()] == [2, 3]


def test_csv_export(spark, tmp_path):
    cells = spark.createDataFrame([(1, r, c, f"{r}{c}", False) for r in range(3) for c in range(2)], "doc_id int, rw bigint, col int, value string, is_num boolean")
    SF.export_csv(cells, str(tmp_path / "csv"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "csv" / "doc_id=1")).collect()]
    assert sorted(lines) == ["00,01", "10,11", "20,21"]


# ---------------------------------------------------------------- lookups and status


def test_lookup_order(spark):
    files = spark.createDataFrame([("a", "a.md", 1), ("a", "a.docx", 2), ("b", "b", 3), ("b", "b.pdf", 4), ("c", "c.jpg", 5)], "file_id string, path string, size int")
    asked = spark.createDataFrame([(i, f) for i, f in enumerate("abcd")], "request_id int, file_id string")
    got = {r.file_id: (r.path, r.error) for r in L.resolve_files(asked, files).collect()}
    assert got == {"a": ("a.docx", None), "b": ("b", None), "c": (None, "File not found"), "d": (None, "File not found")}
    need = {r.file_id: (r.path, r.error) for r in L.require_files(asked, files).collect()}
    assert need["a"] == (None, "PDF file not found") and need["b"] == ("b", None)
    out = L.delete_files(files, spark.createDataFrame([("a",), ("c",), ("a",)], "file_id string"))
    assert sorted(r.path for r in out["deleted"].collect()) == ["a.docx", "a.md"]
    assert sorted(r.path for r in out["kept"].collect()) == ["b", "b.pdf", "c.jpg"]
    assert [r.file_id for r in out["missing"].collect()] == ["c"]


def test_first_result_and_first_feature(spark):
    features = spark.createDataFrame([(1, i, d, False) for i, d in enumerate("xxy")], "project_id int, pos int, description string, passes boolean")
    results = spark.createDataFrame([(1, 5, "x", "fail", "late"), (1, 2, "x", "pass", None)], "project_id int, pos int, name string, status string, error string")
    got = [(r.test_status, r.test_error) for r in L.apply_test_results(features, results).orderBy("pos").collect()]
    assert got == [("pass", None), ("pass", None), (None, None)]
    updates = spark.createDataFrame([(1, "x", True)], "project_id int, description string, passes boolean")
    assert [r.passes for r in L.mark_feature(features, updates).orderBy("pos").collect()] == [True, False, False]


def test_task_status(spark):
    data = [(1, 1, 10, "STARTED", 10.0), (1, 2, 10, "PROGRESS", None), (2, 1, 5, "SUCCESS", None), (3, 1, 5, "FAILURE", None), (4, 1, 5, "PENDING", 3.0), (5, 1, 5, "RETRY", 7.0)]
    events = spark.createDataFrame(data, "task_id int, seq int, t int, state string, progress double").select(
        "task_id", "seq", F.timestamp_seconds("t").alias("ts"), "state", "progress", F.lit("r").alias("result"), F.lit("e").alias("error")
    )
    ids = spark.createDataFrame([(i,) for i in range(1, 7)], "task_id int")
    got = {r.task_id: (r.status, r.result, r.error, r.progress) for r in S.task_status(ids, events).collect()}
    assert got == {
        1: ("PROGRESS", None, None, 0.0), 2: ("SUCCESS", "r", None, None), 3: ("FAILURE", None, "e", None),
        4: ("pending", None, None, None), 5: ("RETRY", None, None, 7.0), 6: ("pending", None, None, None),
    }


def test_hidden_failures(spark):
    data = [("SUCCESS", "failure", True), ("SUCCESS", "success", False), ("SUCCESS", "success", True), ("SUCCESS", None, False), ("FAILURE", None, False), ("STARTED", None, False)]
    got = [(r.effective, r.download) for r in S.effective_status(spark.createDataFrame(data, "state string, result_status string, has_data boolean")).collect()]
    assert got == [
        ("failure", "Conversion failed"), ("success", "No converted file data"), ("success", "ok"), ("failure", "Result is empty"),
        ("failure", "Result not found"), ("started", "Result not found"),
    ]


def test_opposite_priority_orders(spark):
    req = spark.createDataFrame([(1, 1, 1, "pending"), (1, 2, 9, "done"), (1, 3, 5, "pending"), (1, 4, 5, "pending")], "project_id int, seq int, priority int, status string")
    assert S.next_pending(req).first().seq == 3
    feats = spark.createDataFrame([(1, 1, None, None), (1, 2, 5, False), (1, 3, 4, True), (1, 4, 6, False)], "project_id int, pos int, priority int, passes boolean")
    assert S.next_feature(feats).first().pos == 1


# ---------------------------------------------------------------- hygiene


def test_expired_temp(spark):
    ages = [("a.tmp", 1), ("b.tmp", 23), ("c.tmp", 23.5), ("d.tmp", 24), ("e.tmp", 25), ("f.bak", 90), ("g.bak", 99), ("h.TMP", 99)]
    files = spark.createDataFrame([(p, float(h)) for p, h in ages], "path string, h double").withColumn(
        "mtime", F.timestamp_micros((F.unix_micros(now()) - F.col("h") * 3.6e9).cast("bigint"))
    )
    assert [r.path for r in G.expired_temp(files, now()).collect()] == ["e.tmp"]
    assert G.temp_listing(files, now()).count() == 7


def test_keeper_of_equally_new_copies(spark):
    files = spark.createDataFrame([("b", 1, "x"), ("a", 1, "x"), ("c", 0, ""), ("d", 0, "")], "path string, size bigint, content string").withColumn("mtime", now())
    got = {r.path: r.kept for r in G.duplicate_keeper(G.file_digests(files)).collect()}
    assert got == {"a": True, "b": False}


def test_zero_size_exempts_package_markers(spark):
    files = spark.createDataFrame([("p/__init__.py", 0), ("p/x.py", 0), ("p/my__init__.py", 0), ("y", 3)], "path string, size bigint")
    assert sorted(r.path for r in G.zero_size(files).collect()) == ["p/my__init__.py", "p/x.py"]


def test_report_has_the_recorded_shape(spark, tmp_path):
    """Shape of a recorded run: ten empty files, three pairs of copies, thirteen actions."""
    empty = [(f"pkg{i}/empty.txt", 0, "") for i in range(10)]
    pairs = [(f"shots/{i}_{k}.png", 5, f"pic{i}") for i in range(3) for k in "ab"]
    other = [(f"src/{i}.py", 3, f"own{i}") for i in range(230)]
    files = spark.createDataFrame(empty + pairs + other, "path string, size bigint, content string").withColumn("mtime", now())
    digests = G.file_digests(files)
    assert tuple(G.scan_summary(files, digests).first()) == (246, 0, 10, 3, 6, False)
    plan = G.action_plan(files, digests, now()).collect()
    assert len(plan) == 13 and {r.status for r in plan} == {"dry-run"}
    moved = {r.file: (r.moved_to, r.kept) for r in plan}
    assert moved["shots/0_b.png"] == ("99-archive/duplicates/shots__0_b.png", "shots/0_a.png")
    assert moved["pkg3/empty.txt"] == ("99-archive/tombstones/pkg3__empty.txt", None)
    SF.write_report(G.scan_report(files, now()), str(tmp_path / "report"))
    back = spark.read.json(str(tmp_path / "report"))
    assert {r.section: r["count"] for r in back.groupBy("section").count().collect()} == {"summary": 1, "zero_size": 10, "duplicate": 6, "action": 13}


def test_placeholders(spark):
    texts = ["TODO", " - [TBD]: ", "coming \n soon...", "todo list", "", "Placeholder!", "待补充"]
    files = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "path string, content string")
    assert sorted(r.path for r in G.placeholders(files).collect()) == ["0", "1", "2", "5", "6"]


def test_health_bands(spark):
    got = apply(spark, [100, 90, 89, 70, 69, 50, 49, 0], "int", G.health_band)
    assert got == ["excellent", "excellent", "good", "good", "fair", "fair", "poor", "poor"]
    assert apply(spark, [0, 3, 50], "int", G.health_score) == [100, 85, 0]


# ---------------------------------------------------------------- history


def test_superseded_decisions(spark):
    data = [(1, "accepted", None), (2, "accepted", 1), (3, "proposed", None), (4, "accepted", None)]
    got = H.effective_decisions(spark.createDataFrame(data, "decision_id int, status string, supersedes int"))
    assert sorted(r.decision_id for r in got.collect()) == [2, 4]


def test_chains_of_decisions(spark):
    # a rejected one replaces nothing, unless an accepted one stands above it; a circle replaces itself
    data = [(1, "accepted", None), (2, "rejected", 1), (3, "accepted", None), (4, "rejected", 3), (5, "accepted", 4), (6, "accepted", 7), (7, "accepted", 6), (8, "accepted", 8), (9, "accepted", 99)]
    chain = [(100 + i, "accepted" if i in (0, 70) else "rejected", 99 + i if i else None) for i in range(71)]
    got = H.effective_decisions(spark.createDataFrame(data + chain, "decision_id int, status string, supersedes int"))
    assert sorted(r.decision_id for r in got.collect()) == [1, 5, 9, 170]
    assert H.effective_decisions(got.limit(0)).count() == 0


def test_files_without_hash_in_a_snapshot(spark):
    snap = lambda rows: spark.createDataFrame(rows, "path string, hash string")
    got = H.snapshot_diff(snap([("a", None), ("b", "x"), ("c", None), ("d", "y")]), snap([("a", "x"), ("b", None), ("c", None), ("e", None)]))
    assert sorted(map(tuple, got.collect())) == [("a", "modified"), ("b", "modified"), ("d", "removed"), ("e", "added")]


def test_setting_phase_status(spark):
    phases = spark.createDataFrame([(1, "01", "completed", 5), (1, "02", "pending", None), (2, "01", "pending", None)], "project_id int, phase string, status string, completed_at int")
    updates = spark.createDataFrame([(1, "02", "in-progress", 6), (1, "02", "completed", 9), (1, "01", "pending", 7), (3, "01", "completed", 1)], "project_id int, phase string, status string, at int")
    got = {(r.project_id, r.phase): (r.status, r.completed_at, r.completed_phases, r.total_phases, r.progress) for r in H.set_phase_status(phases, updates).collect()}
    assert got == {(1, "01"): ("pending", 5, 1, 2, 50.0), (1, "02"): ("completed", 9, 1, 2, 50.0), (2, "01"): ("pending", None, 0, 1, 0.0)}


def test_features_of_a_project_s_own(spark):
    kind = "array<struct<category:string,description:string,steps:array<string>,priority:int>>"
    req = spark.createDataFrame([(1, "webapp", "", [("ui", "Looks", ["see"], 1), (None, None, None, None)]), (2, "webapp", "", None)], f"project_id int, type string, description string, features {kind}")
    got = D.explode_features(req).filter("project_id = 1").orderBy("pos").collect()[-2:]
    assert [(r.category, r.description, r.steps, r.priority, r.passes) for r in got] == [("ui", "Looks", ["see"], 1, False), ("functional", "", [], 3, False)]
    assert D.explode_features(req).filter("project_id = 2").count() == len(K.BASE_FEATURES)


def test_state_files_by_kind(spark):
    from docfleet.sources import state

    docs = {
        "manifest": {"project-id": "p", "phases": [{"id": "01", "display-name": "x", "completed-at": "t"}], "key-metrics": {"issues-open": 3}, "configuration": {"auto-cleanup": True}, "progress-percentage": 12.5},
        "decisions": {"decisions": [{"id": "D-1", "consequences": {"positive": ["a"]}, "supersedes": "D-0"}]},
        "issues": {"issues": [{"id": "I-1", "severity": "high", "resolved-at": None}]},
        "handoff": {"from-phase": "01", "open-issues": [{"issue": "i", "suggested-action": "s"}]},
        "phase-report": {"phase-id": "01", "metrics": {"tests-passing": 4}, "quality-checks": {"tests-passing": False}, "duration-hours": 1.5},
        "history": {"entries": [{"sequence": 1, "files-affected": ["a"]}]},
    }
    for kind, doc in docs.items():
        texts = spark.createDataFrame([(json.dumps(doc),), (json.dumps(doc)[:-1],)], "doc string")
        good, bad = state.read_state_json(texts, kind).orderBy("broken").collect()
        keep = lambda x: {k: keep(v) for k, v in x.items() if v is not None} if isinstance(x, dict) else [keep(i) for i in x] if isinstance(x, list) else x  # noqa: E731, B023
        assert keep(good.state.asDict(recursive=True)) == keep(doc) and bad.broken and bad.state is None


def test_numbers_go_on_from_what_is_stored(spark):
    df = spark.createDataFrame([(1, "01"), (2, "01"), (3, "02")], "id int, phase string")
    known = spark.createDataFrame([("01", "D-01-007"), ("01", "D-01-1002"), ("03", "D-03-9")], "phase string, label string")
    got = {r.id: r.label for r in H.assign_ids(df, "D", [F.col("id")], stored_rows=known).collect()}
    assert got == {1: "D-01-1003", 2: "D-01-1004", 3: "D-02-001"}


def test_health_of_projects_adds_up(spark):
    files = spark.createDataFrame([(1, "a/01-x.md", 0, ""), (1, "a/01-y.md", 4, "TODO"), (2, "b/Bad.md", 3, "abc"), (2, "a/01-x.md", 2, "ab")], "project_id int, path string, size int, content string").withColumn("mtime", now())
    refs = spark.createDataFrame([(1, "a/01-x.md"), (1, "b/Bad.md"), (None, "zz")], "project_id int, path string")
    state_docs = spark.createDataFrame([(3, True), (3, False)], "project_id int, broken boolean")
    phases = spark.createDataFrame([(1, "01"), (2, "01")], "project_id int, phase string")
    checks = G.health_checks(state_docs, refs, files, phases.filter("project_id = 1"), phases, now())
    got = {(r.scope, r.project_id, r.check): r.violations for r in checks.collect()}
    assert len(got) == 8 * 5
    bad = {k: v for k, v in got.items() if v and k[0] == "project"}
    assert bad == {
        ("project", 3, "state_parses"): 1, ("project", 1, "references_exist"): 1, ("project", None, "references_exist"): 1, ("project", 1, "no_orphans"): 1,
        ("project", 2, "no_orphans"): 2, ("project", 1, "no_empty_files"): 1, ("project", 1, "no_placeholders"): 1, ("project", 2, "names_valid"): 1, ("project", 2, "decisions_recorded"): 1,
    }
    for check in G.HEALTH_CHECKS:
        assert got[("total", None, check)] == sum(v for k, v in got.items() if k[0] == "project" and k[2] == check)
    report = {(r.scope, r.project_id): (r.violations, r.score, r.band) for r in G.health_report(checks).collect()}
    assert report[("project", 1)] == (4, 80, "good") and report[("total", None)] == (10, 50, "fair")


def test_resolving_twice_keeps_other_issues(spark):
    issues = spark.createDataFrame([(1, "open"), (2, "closed")], "issue_id int, status string")
    update = lambda i, text: spark.createDataFrame([(i, text)], "issue_id int, resolution string").withColumn("resolved_at", now())
    once = H.resolve_issues(issues, update(1, "a"))
    twice = H.resolve_issues(once, update(2, "b"))
    assert [(r.issue_id, r.status, r.resolution) for r in twice.orderBy("issue_id").collect()] == [(1, "resolved", "a"), (2, "resolved", "b")]


def test_ids_grow_past_three_digits(spark):
    df = spark.range(1001).select("id", F.lit("02a").alias("phase"))
    got = {r.id: r.label for r in H.assign_ids(df, "D", [F.col("id")]).collect()}
    assert got[0] == "D-02a-001" and got[998] == "D-02a-999" and got[1000] == "D-02a-1001"


def test_appending_starts_after_what_is_there(spark):
    at = F.timestamp_seconds(F.col("event_id"))
    old = spark.createDataFrame([(1, i) for i in range(3)], "project_id int, event_id bigint").withColumn("ts", at)
    new = spark.createDataFrame([(1, 10), (1, 9), (2, 8)], "project_id int, event_id bigint").withColumn("ts", at)
    assert {r.event_id: r.sequence for r in H.append_history(old, new).collect()} == {9: 4, 10: 5, 8: 1}


def test_state_before_the_first_entry_is_null(spark):
    h = spark.createDataFrame([(1, 5, 0, "a")], "project_id int, s int, seq bigint, phase string").withColumn("ts", F.timestamp_seconds("s"))
    p = spark.createDataFrame([(1, 4), (1, 5), (2, 9)], "project_id int, s int").withColumn("at", F.timestamp_seconds("s"))
    got = [tuple(r) for r in H.state_as_of(p, h, ["phase"]).select("project_id", F.unix_seconds("at"), "phase").collect()]
    assert sorted(got, key=repr) == [(1, 4, None), (1, 5, "a"), (2, 9, None)]


# ---------------------------------------------------------------- conversion


def test_conversions_and_their_errors(spark):
    sheet = json.dumps([["h", "n"], ["a", 0], [None, 1.5], [False, "0"], [True, ""]])
    blocks = json.dumps([{"style": "Heading 2", "text": "t"}, {"style": "Normal", "text": " "}, {"text": "x"}])
    bad = json.dumps([{"style": "TOC Heading", "text": "t"}])
    data = [
        ("csv", "excel_to_csv", sheet), ("rows", "excel_to_pdf", sheet), ("md", "word_to_markdown", blocks), ("pages", "word_to_pdf", blocks),
        ("bad", "word_to_markdown", bad), ("html", "markdown_to_html", "# a\nb"), ("empty", "markdown_to_html", ""), ("none", "pdf_to_excel", "x"),
        ("join", "pdf_to_html", json.dumps(["p1", "p2"])), ("broken", "excel_to_csv", "[["), ("null", "pdf_to_html", None), ("blocks", "markdown_to_word", "# a\n- b"),
    ]
    files = spark.createDataFrame(data, "file_id string, conversion_type string, content string")
    got = {r.file_id: r for r in C.convert_batch(files).collect()}
    assert got["csv"].data == "h,n\na,\n,1.5\n,0\ntrue," and got["csv"].content_type == "text/csv"
    assert json.loads(got["rows"].data) == [["a", "0"], ["", "1.5"], ["false", "0"], ["true", ""]]
    assert got["md"].data == "## t\n\n \n\nx\n" and json.loads(got["pages"].data) == ["t", "x"]
    assert (got["bad"].status, got["bad"].data, got["bad"].error) == ("failure", None, "invalid heading level")
    assert got["html"].data == "<h1>a</h1>\n<p>b</p>"
    assert (got["empty"].status, got["empty"].data, got["empty"].content_type, got["empty"].error) == ("success", None, None, None)
    assert got["none"].error == "Unsupported conversion type: pdf_to_excel"
    assert got["join"].data == "p1<hr/>p2" and got["broken"].status == got["null"].status == "failure"
    assert [b["kind"] for b in json.loads(got["blocks"].data)] == ["heading", "bullet"]


def test_python_converters_and_fallback(spark):
    registry = C.native_registry()
    seen = spark.sparkContext.accumulator(0)

    def tenth(texts):
        seen.add(1)
        return pa.array([str(10 // int(t)) for t in texts.to_pylist()])

    registry.register("svg_to_png", batch=tenth)
    files = spark.createDataFrame([(i, "svg_to_png" if i < 3 else "pdf_to_html", t) for i, t in enumerate(["5", "0", "x", '["p"]'])], "file_id int, conversion_type string, content string")
    got = {r.file_id: (r.status, r.data, r.error) for r in C.convert_batch(files, registry).collect()}
    assert got[0] == ("success", "2", None) and got[1][0] == "failure" and "zero" in got[1][2] and got[2][0] == "failure" and got[3][1] == "p"
    seen.value = 0
    many = spark.range(1, 1025, numPartitions=1).select(F.col("id").alias("file_id"), F.lit("svg_to_png").alias("conversion_type"), F.when(F.col("id") == 700, "x").otherwise("5").alias("content"))
    assert {r.file_id for r in C.convert_batch(many, registry).filter("status = 'failure'").collect()} == {700}
    assert seen.value <= 1 + 2 * 10  # a bad row among 1024 costs two tries for each halving
    df = spark.createDataFrame([("a", "b"), (None, "b"), (None, None)], "p string, q string")
    used = [tuple(r.r) for r in df.select(C.with_fallback(F.col("p"), F.col("q")).alias("r")).collect()]
    assert used == [("a", False), ("b", True), (None, False)]


def test_long_lists_and_unicode_blanks_in_html(spark):
    texts = [("\n".join(f"- item {i}" for i in range(100_000)),), ("# T\u3000",)]
    html = [r.h for r in spark.createDataFrame(texts, "t string").select(M.text_to_html(F.col("t")).alias("h")).collect()]
    assert html[0].count("<li>") == 100_000 and html[0].count("<ul>") == 1 and html[1] == "<h1>T</h1>"


def test_repeated_updates_do_not_multiply_rows(spark):
    features = spark.createDataFrame([(1, 0, "a", False), (1, 1, "b", False)], "project_id int, pos int, description string, passes boolean")
    updates = spark.createDataFrame([(1, "a", True), (1, "a", True), (1, "b", True), (1, "b", False)], "project_id int, description string, passes boolean")
    assert [r.passes for r in L.mark_feature(features, updates).orderBy("pos").collect()] == [True, False]
    issues = spark.createDataFrame([(1, "open")], "issue_id int, status string")
    new = spark.createDataFrame([(1, 5, "old"), (1, 9, "new")], "issue_id int, resolved_at int, resolution string")
    assert [(r.status, r.resolution) for r in H.resolve_issues(issues, new).collect()] == [("resolved", "new")]


def test_projects_named_by_strings_and_known_from_issues_only(spark):
    history = spark.createDataFrame([("p", 1, "01", 1), ("q", 2, "02", 2)], "project_id string, ts int, phase string, event_id int")
    timed = history.withColumn("ts", F.timestamp_seconds("ts"))
    assert {r.project_id: r.active for r in H.projects_by_activity(timed).collect()} == {"p": False, "q": True}
    issues = spark.createDataFrame([("z", "open")], "project_id string, status string")
    phases = spark.createDataFrame([], "project_id string, phase string, status string")
    got = {r.project_id: r.open_issues for r in H.current_status(timed, issues, issues.limit(0), phases).collect()}
    assert got == {"p": 0, "q": 0, "z": 1}


def test_entries_without_hashes_stay(spark):
    entries = spark.createDataFrame([(1, ["a", "b"]), (2, ["b"]), (3, [])], "entry_id int, files_affected array<string>")
    digests = spark.createDataFrame([("a", "h")], "path string, hash string")
    got = {r.entry_id: (r.context_hash[:4], r.without_hash) for r in H.context_hash(entries, digests).collect()}
    assert {k: v[1] for k, v in got.items()} == {1: ["b"], 2: ["b"], 3: []} and got[2][0] == got[3][0] == "e3b0"
