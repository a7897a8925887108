"""Conversion of whole files by type, with errors kept per row."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from docfleet.functions import constants as K
from docfleet.functions import markdown as M
from docfleet.functions.scalars import content_type, is_blank, let, lookup, output_format, strip

ColumnConverter = Callable[[Column], Column]
BatchConverter = Callable[[pa.Array], pa.Array]


@dataclass
class Registry:
    """Converters by conversion type: column functions, or functions on Arrow arrays of contents.

    A column function returns text, or a struct (data, error) where a row can fail. A batch function
    gets an array of texts and returns one of as many; it raises where it can't. ``content_type`` is the
    media type of what a converter gives; without it the target of the conversion names one.
    """

    columns: dict[str, ColumnConverter] = field(default_factory=dict)
    batches: dict[str, BatchConverter] = field(default_factory=dict)
    content_types: dict[str, str] = field(default_factory=dict)

    def register(
        self, conversion_type: str, column: ColumnConverter | None = None, batch: BatchConverter | None = None, content_type: str | None = None
    ) -> None:
        if (column is None) == (batch is None):
            raise ValueError("give either a column function or a batch function")
        for known in (self.columns, self.batches, self.content_types):
            known.pop(conversion_type, None)
        if column is not None:
            self.columns[conversion_type] = column
        else:
            self.batches[conversion_type] = batch
        if content_type is not None:
            self.content_types[conversion_type] = content_type


def convert_values(convert: BatchConverter, values: pa.Array) -> tuple[list[str | None], list[str | None]]:
    """Results and errors. Where a batch fails its halves are tried, so a bad row among n costs log2(n) retries."""
    if not len(values):
        return [], []
    try:
        made = convert(values)
        if len(made) != len(values):
            raise ValueError(f"{len(made)} results for {len(values)} contents")
        return pa.array(made).cast(pa.string()).to_pylist(), [None] * len(values)
    except Exception as e:  # one bad file never fails the batch
        if len(values) == 1:
            return [None], [str(e) or type(e).__name__]
    half = len(values) // 2
    left, right = (convert_values(convert, part) for part in (values.slice(0, half), values.slice(half)))
    return left[0] + right[0], left[1] + right[1]


def with_fallback(primary: Column, secondary: Column) -> Column:
    """Struct (value, used_fallback): the second converter where the first gives nothing."""
    return F.struct(
        F.coalesce(primary, secondary).alias("value"),
        (primary.isNull() & secondary.isNotNull()).alias("used_fallback"),
    )


def _result(data: Column, error: Column) -> Column:
    return F.struct(data.alias("data"), error.alias("error"))


def blocks_to_markdown(content: Column) -> Column:
    """JSON list of {"style", "text"} -> Markdown text."""

    def line(block: Column) -> Column:
        style = F.lower(F.coalesce(block["style"], F.lit("")))
        rest = strip(F.replace(style, F.lit("heading"), F.lit("")))
        level = F.when(rest == "", F.lit(1)).when(rest.rlike(r"^[+-]?[0-9]+\z"), rest.try_cast("int"))
        text = F.coalesce(block["text"], F.lit(""))
        heading = F.when(level.isNotNull(), F.concat(F.repeat(F.lit("#"), F.greatest(level, F.lit(0))), F.lit(" "), text))
        return F.concat(F.when(F.contains(style, F.lit("heading")), heading).otherwise(text), F.lit("\n"))

    def render(blocks: Column) -> Column:
        lines = F.transform(blocks, line)
        bad = F.exists(lines, lambda x: x.isNull())
        return _result(
            F.when(~bad, F.array_join(lines, "\n")),
            F.when(blocks.isNull(), "content is not a list of blocks").when(bad, "invalid heading level"),
        )

    return let(F.from_json(content, "array<struct<style:string,text:string>>"), render)


def blocks_to_pages(content: Column) -> Column:
    """JSON list of blocks -> JSON list of page texts, one per non-blank block."""

    def render(blocks: Column) -> Column:
        texts = F.filter(F.transform(blocks, lambda b: b["text"]), lambda t: t.isNotNull() & ~is_blank(t))
        return _result(F.to_json(texts), F.when(blocks.isNull(), "content is not a list of blocks"))

    return let(F.from_json(content, "array<struct<style:string,text:string>>"), render)


def _is_falsy(cell: Column) -> Column:
    kind = F.schema_of_variant(cell)
    text = F.try_variant_get(cell, "$", "string")
    number = F.try_variant_get(cell, "$", "double")
    return (
        F.is_variant_null(cell)
        | (text == "")
        | ((kind != "STRING") & (F.coalesce(number == 0, F.lit(False)) | (text == "false")))
    )


def sheet_to_csv(content: Column) -> Column:
    """JSON list of rows (lists of cells) -> comma-joined lines; falsy cells are left blank."""

    def render(rows: Column) -> Column:
        cell = lambda c: F.when(_is_falsy(c), "").otherwise(F.try_variant_get(c, "$", "string"))
        lines = F.transform(rows, lambda r: F.array_join(F.transform(r.cast("array<variant>"), cell), ","))
        return _result(F.array_join(lines, "\n"), F.when(rows.isNull(), "content is not a list of rows"))

    return let(_rows(content), render)


def sheet_to_rows(content: Column) -> Column:
    """JSON list of rows -> JSON list of rows of text without the first; null is shown as ''."""

    def render(rows: Column) -> Column:
        text = lambda c: F.coalesce(F.try_variant_get(c, "$", "string"), F.lit(""))
        shown = F.transform(
            F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0))),
            lambda r: F.transform(r.cast("array<variant>"), text),
        )
        return _result(F.to_json(shown), F.when(rows.isNull(), "content is not a list of rows"))

    return let(_rows(content), render)


def _rows(content: Column) -> Column:
    return F.try_variant_get(F.try_parse_json(content), "$", "array<variant>")


def pages_to_html(content: Column) -> Column:
    """JSON list of page texts -> the pages joined by a rule."""
    return let(
        F.from_json(content, "array<string>"),
        lambda pages: _result(
            F.array_join(pages, "<hr/>", ""), F.when(pages.isNull(), "content is not a list of pages")
        ),
    )


def native_registry() -> Registry:
    """The conversions whose work is text and tables."""
    r = Registry()
    r.register("markdown_to_html", M.text_to_html)
    # blocks, pages and rows are what a renderer of the byte format takes; here they are JSON
    r.register("markdown_to_word", lambda c: F.to_json(M.text_to_blocks(c)), content_type=K.JSON_TYPE)
    r.register("word_to_markdown", blocks_to_markdown)
    r.register("word_to_pdf", blocks_to_pages, content_type=K.JSON_TYPE)
    r.register("excel_to_csv", sheet_to_csv)
    r.register("excel_to_pdf", sheet_to_rows, content_type=K.JSON_TYPE)
    r.register("pdf_to_html", pages_to_html)
    return r


def convert_batch(files: DataFrame, registry: Registry | None = None) -> DataFrame:
    """files(file_id, conversion_type, content) -> status, data, content_type, error per file.

    Every row is converted on its own and fails on its own. An empty result is a success without
    data. Rows of batch converters are the only ones that leave the JVM, in Arrow batches.
    """
    registry = registry or native_registry()
    kind = F.col("conversion_type")
    # a string column made of mixed converters: each is wrapped to the same struct
    chosen = _result(F.lit(None).cast("string"), F.concat(F.lit(K.MSG_UNSUPPORTED), kind))
    probe = files.limit(0)
    for name, converter in registry.columns.items():
        made = converter(F.col("content"))
        if not probe.select(made.alias("r")).schema["r"].dataType.typeName() == "struct":
            made = _result(made, F.lit(None).cast("string"))
        chosen = F.when(kind == name, made).otherwise(chosen)
    chosen = F.when(F.col("content").isNull(), _result(F.lit(None).cast("string"), F.lit("no content"))).otherwise(chosen)
    theirs = kind.isin(list(registry.batches)) & F.col("content").isNotNull()
    native = files.filter(~F.coalesce(theirs, F.lit(False))) if registry.batches else files
    out = native.select("file_id", "conversion_type", chosen.alias("r")).select("file_id", "conversion_type", "r.*")
    if registry.batches:
        functions = dict(registry.batches)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds = batch.column("conversion_type")
                for name in pc.unique(kinds).to_pylist():
                    own = batch.filter(pc.equal(kinds, name))
                    data, error = convert_values(functions[name], own.column("content").cast(pa.string()))
                    yield pa.RecordBatch.from_arrays(
                        [own.column("file_id"), own.column("conversion_type"), pa.array(data, pa.string()), pa.array(error, pa.string())],
                        ["file_id", "conversion_type", "data", "error"],
                    )

        schema = f"file_id {dict(files.dtypes)['file_id']}, conversion_type string, data string, error string"
        out = out.unionByName(files.filter(theirs).select("file_id", "conversion_type", "content").mapInArrow(run, schema))
    filled = F.nullif(F.col("data"), F.lit(""))
    failed, named = F.col("error").isNotNull(), content_type(output_format(kind))
    return out.select(
        "file_id",
        "conversion_type",
        F.when(failed, "failure").otherwise("success").alias("status"),
        F.when(~failed, filled).alias("data"),
        F.when(~failed & filled.isNotNull(), lookup(registry.content_types, kind, named) if registry.content_types else named).alias("content_type"),
        "error",
    )
