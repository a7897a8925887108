"""Pages, blocks, lines and sheet cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from docfleet.functions import constants as K
from docfleet.functions import markdown as M
from docfleet.functions.scalars import base_name, is_blank, strip
from docfleet.plans.ordered import (
    explode_range,
    ordered_parts,
    running_sum_by_position,
    with_neighbours,
)

# ---------------------------------------------------------------- pages


def paginate_nonblank(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> pages(doc_id, page, text): one page per non-blank line, from 1.

    The lines of a document sit in one row, so they are numbered there, without a shuffle.
    """
    lines = F.filter(F.split("text", "\n", -1), lambda line: ~is_blank(line))
    return docs.select("doc_id", F.posexplode(lines).alias("pos", "text")).select(
        "doc_id", (F.col("pos") + 1).cast("bigint").alias("page"), "text"
    )


def assemble_pages(pages: DataFrame, with_markers: bool = True, **parts) -> DataFrame:
    """pages -> (doc_id, part, text): the pages in order, each under its ``--- Page n ---`` line."""
    text = F.col("text")
    if with_markers:
        text = F.concat(F.lit("--- Page "), F.col("page").cast("string"), F.lit(" ---\n\n"), text)
    return ordered_parts(pages, ["doc_id"], "page", text, "\n", **parts)


def join_pages(pages: DataFrame, sep: str = "<hr/>", **parts) -> DataFrame:
    return ordered_parts(pages, ["doc_id"], "page", F.col("text"), sep, **parts)


def parse_page_ranges(requests: DataFrame) -> DataFrame:
    """requests(request_id, doc_id, ranges) -> one row per readable range: range_pos, lo, hi."""
    bounds = F.split("item", "-", -1)
    number = lambda i: strip(F.get(bounds, F.lit(i))).try_cast("bigint")
    return requests.select("request_id", "doc_id", F.posexplode("ranges").alias("range_pos", "item")).select(
        "request_id",
        "doc_id",
        F.col("range_pos").cast("bigint").alias("range_pos"),
        number(0).alias("lo"),
        F.coalesce(number(1), number(0)).alias("hi"),
    )


def _unreadable_ranges() -> Column:
    number = rf"[{K.BLANKS}]*\+?[0-9]+[{K.BLANKS}]*"
    return F.filter("ranges", lambda r: ~r.rlike(rf"^{number}(?:-{number})?\z"))


def check_page_ranges(requests: DataFrame) -> DataFrame:
    """(request_id, status, error): one range that cannot be read fails the whole request."""
    wrong = _unreadable_ranges()
    return requests.select(
        "request_id",
        F.when(F.size(wrong) > 0, "failure").otherwise("success").alias("status"),
        F.when(F.size(wrong) > 0, F.concat(F.lit("invalid page range: "), wrong[0])).alias("error"),
    )


def page_counts(pages: DataFrame) -> DataFrame:
    return pages.groupBy("doc_id").agg(F.max("page").cast("bigint").alias("n_pages"))


def _take_ranges(ranges: DataFrame, pages: DataFrame, key: str, pos: str) -> DataFrame:
    """Rows (key, doc_id, pos, lo, hi) -> the pages of each range, numbered through per key.

    A range is cut to the pages there are, then opened into page numbers and matched by equality
    on (doc_id, page), which is unique on the page side. Numbers come from running range lengths.
    """
    cut = (
        ranges.withColumn("lo", F.greatest(F.col("lo"), F.lit(1)))
        .withColumn("hi", F.least(F.col("hi"), F.col("n_pages")))
        .withColumn("len", F.greatest(F.col("hi") - F.col("lo") + 1, F.lit(0)))
    )
    placed = running_sum_by_position(cut, [key], pos, F.col("len"), "end")
    wanted = explode_range(
        placed.select(key, pos, "doc_id", "lo", "hi", (F.col("end") - F.col("len")).alias("before")),
        [key, pos],
        "lo",
        "hi",
        "page",
    )
    found = wanted.join(pages.select("doc_id", "page", "text"), ["doc_id", "page"])
    return found.select(
        key, (F.col("before") + F.col("page") - F.col("lo") + 1).alias("out_page"), "doc_id", "page", "text"
    )


def select_pages(pages: DataFrame, requests: DataFrame) -> DataFrame:
    """Pages of the requested ranges, in range order, repeats kept.

    Ranges are 1-based and inclusive. Pages outside the document are dropped, a reversed range is
    empty, and a request with an unreadable range gives nothing (see :func:`check_page_ranges`).
    """
    ranges = parse_page_ranges(requests.filter(F.size(_unreadable_ranges()) == 0))
    known = ranges.join(page_counts(pages), "doc_id")
    return _take_ranges(known, pages, "request_id", "range_pos")


def merge_documents(pages: DataFrame, doc_order: DataFrame) -> DataFrame:
    """doc_order(merge_id, pos, doc_id) -> all pages in that order, renumbered per merge."""
    known = doc_order.join(page_counts(pages), "doc_id")
    whole = known.withColumn("lo", F.lit(1).cast("bigint")).withColumn("hi", F.col("n_pages"))
    return _take_ranges(whole, pages, "merge_id", "pos")


def extract_embedded(pages: DataFrame, attribute: str = "href") -> DataFrame:
    """pages(page_id, html) -> (page_id, index, target): every linked object, 0-based per page."""
    found = F.regexp_extract_all("html", F.lit(f'{attribute}="([^"]*)"'), F.lit(1))
    return pages.select("page_id", F.posexplode(found).alias("index", "target")).select(
        "page_id", F.col("index").cast("bigint").alias("index"), "target"
    )


# ---------------------------------------------------------------- Markdown


def _fence_state(lines: DataFrame) -> DataFrame:
    fence = M.is_fence(F.col("line"))
    counted = running_sum_by_position(
        lines, ["doc_id"], "pos", F.when(fence, 1).otherwise(0).cast("bigint"), "_fences"
    )
    return counted.withColumn("_fence", fence).withColumn("_inside", F.col("_fences") % 2 == 1)


def _classified(lines: DataFrame) -> DataFrame:
    line = F.col("line")
    state = _fence_state(lines)
    kind = (
        F.when(F.col("_fence"), F.when(F.col("_inside"), "open").otherwise("close"))
        .when(F.col("_inside"), "code")
        .otherwise(M.line_kind(line))
    )
    return state.select(
        "doc_id",
        "pos",
        kind.alias("kind"),
        F.when(kind == "heading", M.heading_level(line)).cast("int").alias("level"),
        F.when(kind == "heading", M.heading_text(line)).otherwise(line).alias("text"),
    )


def classify_markdown(lines: DataFrame) -> DataFrame:
    """lines(doc_id, pos, line) -> blocks(doc_id, pos, kind, level, text); fence lines are dropped."""
    return _classified(lines).filter(~F.col("kind").isin("open", "close"))


def render_markdown(blocks: DataFrame, **parts) -> DataFrame:
    """blocks(doc_id, pos, style, text) -> (doc_id, part, markdown, error).

    A heading style whose level is not a number fails its document, which then has one row with
    the error and no text.
    """
    style = F.lower("style")
    is_heading = F.contains(style, F.lit("heading"))
    rest = strip(F.replace(style, F.lit("heading"), F.lit("")))
    level = F.when(rest == "", F.lit(1)).when(rest.rlike(r"^[+-]?[0-9]+\z"), rest.try_cast("int"))
    line = F.when(
        is_heading, F.concat(F.repeat(F.lit("#"), F.greatest(level, F.lit(0))), F.lit(" "), F.col("text"))
    ).otherwise(F.col("text"))
    marked = blocks.withColumn("_bad", F.when(is_heading & level.isNull(), rest)).withColumn(
        "_line", F.concat(F.coalesce(line, F.lit("")), F.lit("\n"))
    )
    failed = marked.groupBy("doc_id").agg(F.min("_bad").alias("_bad")).filter(F.col("_bad").isNotNull())
    text = ordered_parts(marked, ["doc_id"], "pos", F.col("_line"), "\n", out="markdown", **parts)
    good = text.join(failed, "doc_id", "left_anti").withColumn("error", F.lit(None).cast("string"))
    bad = failed.select(
        "doc_id",
        F.lit(0).cast("bigint").alias("part"),
        F.lit(None).cast("string").alias("markdown"),
        F.concat(F.lit("invalid heading level: "), F.col("_bad")).alias("error"),
    )
    return good.unionByName(bad)


def render_html(lines: DataFrame, **parts) -> DataFrame:
    """lines(doc_id, pos, line) -> (doc_id, part, html): headings, paragraphs, lists and code.

    Positions must be gapless, because list runs are found from the neighbouring rows.
    """
    near = with_neighbours(
        _classified(lines), ["doc_id"], "pos", {"_before": ("kind", -1), "_after": ("kind", 1)}
    )
    kind, text = F.col("kind"), M.escape_html(F.col("text"))
    is_not = lambda c, k: F.coalesce(F.col(c) != k, F.lit(True))
    last = F.col("_after").isNull()
    level = F.col("level").cast("string")
    html = (
        F.when(kind == "heading", F.concat(F.lit("<h"), level, F.lit(">"), text, F.lit("</h"), level, F.lit(">")))
        .when(
            kind == "bullet",
            F.concat(
                F.when(is_not("_before", "bullet"), "<ul>\n").otherwise(""),
                F.lit("<li>"),
                F.substring(text, 3, 2_147_483_647),
                F.lit("</li>"),
                F.when(is_not("_after", "bullet"), "\n</ul>").otherwise(""),
            ),
        )
        .when(kind == "open", F.concat(F.lit("<pre><code>"), F.when(last, "\n</code></pre>").otherwise("")))
        .when(kind == "close", "</code></pre>")
        .when(kind == "code", F.concat(text, F.when(last, "\n</code></pre>").otherwise("")))
        .when(text != "", F.concat(F.lit("<p>"), text, F.lit("</p>")))
    )
    shown = near.withColumn("_html", html).filter(F.col("_html").isNotNull())
    return ordered_parts(shown, ["doc_id"], "pos", F.col("_html"), "\n", out="html", **parts)


# ---------------------------------------------------------------- sheets


def is_falsy(value: Column, is_num: Column) -> Column:
    """Null, empty text, and numeric or logical zero."""
    return (
        value.isNull()
        | (value == "")
        | (is_num & F.coalesce(value.try_cast("double") == 0, F.lower(value) == "false"))
    )


def sheet_rows(cells: DataFrame) -> DataFrame:
    """cells(doc_id, rw, col, value) -> (doc_id, rw, values): header dropped, null shown as ''."""
    return (
        cells.filter(F.col("rw") > 0)
        .groupBy("doc_id", "rw")
        .agg(F.sort_array(F.collect_list(F.struct("col", F.coalesce("value", F.lit("")).alias("v")))).alias("c"))
        .select("doc_id", "rw", F.transform("c", lambda x: x["v"]).alias("values"))
    )


def sheet_used_range(cells: DataFrame, widths: DataFrame | None = None, default_width: float = 8.0) -> DataFrame:
    """First and last row and column (1-based) with a value, and the width of all columns up to
    the last one; a column without a width, or with width 0, counts as ``default_width``."""
    used = (
        cells.filter(F.col("value").isNotNull())
        .groupBy("doc_id")
        .agg(
            (F.min("rw") + 1).cast("bigint").alias("min_row"),
            (F.max("rw") + 1).cast("bigint").alias("max_row"),
            (F.min("col") + 1).cast("bigint").alias("min_col"),
            (F.max("col") + 1).cast("bigint").alias("max_col"),
        )
    )
    total = F.col("max_col") * F.lit(default_width)
    if widths is None:
        return used.withColumn("total_width", total)
    given = widths.filter(F.coalesce(F.col("width"), F.lit(0.0)) != 0).withColumnRenamed("col", "_col")
    extra = (
        given.join(used.select("doc_id", "max_col"), "doc_id")
        .filter(F.col("_col") < F.col("max_col"))
        .groupBy("doc_id")
        .agg(F.sum(F.col("width") - default_width).alias("_extra"))
    )
    return (
        used.join(extra, "doc_id", "left")
        .withColumn("total_width", total + F.coalesce("_extra", F.lit(0.0)))
        .drop("_extra")
    )


# ---------------------------------------------------------------- checks and listings


def page_quality(pages: DataFrame) -> DataFrame:
    """pages(doc_id, page, text, images) -> the same keys, stripped text length and issues."""
    length = F.length(strip(F.col("text")))
    return pages.select(
        "doc_id",
        "page",
        length.cast("bigint").alias("text_length"),
        F.col("images").cast("bigint").alias("images"),
        F.array_compact(
            F.array(
                F.when(length < 10, K.MSG_LITTLE_TEXT),
                F.when((F.col("images") == 0) & (length < 50), K.MSG_MAYBE_EMPTY),
            )
        ).alias("issues"),
    )


def document_quality(pages: DataFrame) -> DataFrame:
    """Per document: pages, pages with issues, issues of either kind."""
    checked = page_quality(pages)
    has = lambda message: F.array_contains("issues", message)
    return checked.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.size("issues") > 0).alias("pages_with_issues"),
        F.count_if(has(K.MSG_LITTLE_TEXT)).alias("little_text"),
        F.count_if(has(K.MSG_MAYBE_EMPTY)).alias("maybe_empty"),
    )


def search_content(files: DataFrame, pattern: str, path: str = ".") -> DataFrame:
    """All paths, in path order, whose content holds ``pattern`` as plain text."""
    hits = files if path == "." else files.filter(F.contains("path", F.lit(path)))
    return hits.filter(F.contains("content", F.lit(pattern))).select("path").orderBy("path")


def glob_regex(glob: str) -> str:
    """Shell pattern on a file name as a regular expression."""
    out, i = "", 0
    while i < len(glob):
        char = glob[i]
        close = glob.find("]", i + 2) if char == "[" else -1
        if char == "*":
            out += "[^/]*"
        elif char == "?":
            out += "[^/]"
        elif close > 0:
            body = glob[i + 1 : close].replace("\\", "\\\\")
            out += "[" + ("^" + body[1:] if body.startswith("!") else body) + "]"
            i = close
        else:
            out += char if char.isalnum() or char in "_/ " else "\\" + char
        i += 1
    return rf"^{out}\z"


def list_matching(files: DataFrame, glob: str = "*") -> DataFrame:
    """All paths, in path order, whose file name matches ``glob``."""
    return files.filter(base_name(F.col("path")).rlike(glob_regex(glob))).select("path").orderBy("path")


def complex_files(
    files: DataFrame,
    extensions: Sequence[str] = ("js", "jsx", "py"),
    max_lines: int = 500,
    allowed: int = 5,
) -> DataFrame:
    """One row: how many of the source files are too long, and is that acceptable?"""
    ext = F.substring_index("path", ".", -1)
    chosen = files.filter(ext.isin(list(extensions)) & F.contains("path", F.lit(".")))
    too_long = F.count_if(F.size(F.split("content", "\n", -1)) > max_lines)
    return chosen.agg(
        F.count(F.lit(1)).alias("checked"), too_long.alias("complex"), (too_long < allowed).alias("passed")
    )


def explode_features(requirements: DataFrame) -> DataFrame:
    """requirements(project_id, type, description[, features]) -> the feature list of every project.

    The fixed features come from array literals in the row, so the catalogue needs no join. They are
    followed by the lines of the description, and by the project's own ``features``, an array of
    struct(category, description, steps, priority) whose missing fields are functional, '', none and 3.
    """

    def fixed(items) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(category).alias("category"),
                    F.lit(description).alias("description"),
                    F.array(*[F.lit(s) for s in steps]).alias("steps"),
                    F.lit(priority).alias("priority"),
                )
                for category, description, steps, priority in items
            ]
        )

    lines = F.filter(F.split("description", "\n", -1), lambda line: ~is_blank(line))
    own = F.transform(
        lines,
        lambda line: F.struct(
            F.lit("functional").alias("category"),
            strip(line).alias("description"),
            F.array().cast("array<string>").alias("steps"),
            F.lit(1).alias("priority"),
        ),
    )
    given = []
    if "features" in requirements.columns:
        custom = F.transform(
            F.filter(F.coalesce("features", F.array().cast(dict(requirements.dtypes)["features"])), lambda f: f.isNotNull()),
            lambda f: F.struct(
                F.coalesce(f["category"], F.lit("functional")).alias("category"),
                F.coalesce(f["description"], F.lit("")).alias("description"),
                F.coalesce(f["steps"], F.array().cast("array<string>")).alias("steps"),
                F.coalesce(f["priority"].cast("int"), F.lit(3)).alias("priority"),
            ),
        )
        given.append(custom)
    api = F.when(F.col("type") == "api", fixed(K.API_FEATURES)).otherwise(F.slice(fixed(K.API_FEATURES), 1, 0))
    return requirements.select(
        "project_id", F.posexplode(F.concat(api, fixed(K.BASE_FEATURES), own, *given)).alias("pos", "f")
    ).select("project_id", F.col("pos").cast("bigint").alias("pos"), "f.*", F.lit(False).alias("passes"))
