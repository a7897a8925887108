"""Markdown line rules, as expressions on one line or on one whole text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from docfleet.functions import constants as K
from docfleet.functions.scalars import strip

FENCE = "```"


def is_fence(line: Column) -> Column:
    return F.startswith(line, F.lit(FENCE))


def line_kind(line: Column) -> Column:
    """Kind of a line outside a code fence."""
    return (
        F.when(F.startswith(line, F.lit("#")), "heading")
        .when(F.startswith(line, F.lit("- ")) | F.startswith(line, F.lit("* ")), "bullet")
        .otherwise("paragraph")
    )


def heading_level(line: Column) -> Column:
    """Number of leading # signs, at most 6."""
    return F.least(F.length(F.regexp_extract(line, "^#+", 0)), F.lit(6))


def heading_text(line: Column) -> Column:
    return strip(F.regexp_replace(line, "^#+", ""))


def escape_html(text: Column) -> Column:
    amp = F.replace(text, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(amp, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def line_to_block(line: Column) -> Column:
    """Struct (kind, level, text) of a line outside a fence."""
    kind = line_kind(line)
    return F.struct(
        kind.alias("kind"),
        F.when(kind == "heading", heading_level(line)).alias("level"),
        F.when(kind == "heading", heading_text(line)).otherwise(line).alias("text"),
    )


def text_to_blocks(text: Column) -> Column:
    """Array of blocks of one Markdown text, code fences included.

    The text is cut at its fence lines; every second piece is code. Works inside one row, so no
    shuffle is needed when documents arrive as whole texts.
    """
    pieces = F.split(F.concat(F.lit("\n"), text), r"\n```[^\n]*(?=\n|\z)", -1)
    code = lambda line: F.struct(
        F.lit("code").alias("kind"), F.lit(None).cast("int").alias("level"), line.alias("text")
    )

    def piece_blocks(piece: Column, i: Column) -> Column:
        # each piece but an empty one starts with the newline that ended the line before it
        lines = F.when(piece == "", F.array().cast("array<string>")).otherwise(
            F.split(F.substring(piece, 2, 2_147_483_647), "\n", -1)
        )
        return F.when(i % 2 == 1, F.transform(lines, code)).otherwise(F.transform(lines, line_to_block))

    return F.flatten(F.transform(pieces, piece_blocks))


# blanks within a line, as strip takes them
BLANK = rf"[{K.BLANKS}&&[^\n]]"


def text_to_html(text: Column) -> Column:
    """Block-level HTML of one Markdown text: headings, paragraphs, bullet lists, code."""
    pieces = F.split(F.concat(F.lit("\n"), escape_html(text)), r"\n```[^\n]*(?=\n|\z)", -1)

    def piece_html(piece: Column, i: Column) -> Column:
        code = F.concat(F.lit("\n<pre><code>"), piece, F.lit("\n</code></pre>"))
        html = piece
        for level in range(6, 0, -1):
            # more than six signs still make an h6
            signs = "#{6,}" if level == 6 else "#" * level
            html = F.regexp_replace(
                html, rf"\n{signs}{BLANK}*([^\n]*?){BLANK}*(?=\n|\z)", f"\n<h{level}>$1</h{level}>"
            )
        # possessive, so that a list of any length is matched in a loop and not by recursion
        html = F.regexp_replace(html, r"((?:\n[-*] [^\n]*+)++)", "\n<ul>$1\n</ul>")
        html = F.regexp_replace(html, r"\n[-*] ([^\n]*)", "\n<li>$1</li>")
        html = F.regexp_replace(html, r"\n([^<\n][^\n]*)", "\n<p>$1</p>")
        return F.when(i % 2 == 1, code).otherwise(F.regexp_replace(html, r"\n+(?=\n|\z)", ""))

    return F.regexp_replace(F.array_join(F.transform(pieces, piece_html), ""), r"\A\n", "")
