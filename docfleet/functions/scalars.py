"""Column -> Column functions on file names, sizes, types and times. All stay in codegen."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from itertools import chain

from pyspark.sql import Column, functions as F

from docfleet.functions import constants as K


def lookup(mapping: Mapping[str, str], key: Column, default: Column | None = None) -> Column:
    """Value of ``key`` in a fixed mapping, else ``default`` (null if not given)."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    value = F.try_element_at(table, key)
    return value if default is None else F.coalesce(value, default)


def div(number: Column, by: int) -> Column:
    """Whole-number division."""
    return F.call_function("div", number.cast("bigint"), F.lit(by).cast("bigint"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it any number of times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    """Drop leading and trailing white space, in the Unicode sense."""
    return F.btrim(text, F.lit(K.BLANK_CHARS))


def is_blank(text: Column) -> Column:
    return F.ltrim(text, F.lit(K.BLANK_CHARS)) == ""


def file_extension(name: Column) -> Column:
    """Part after the last dot, lower-cased; empty if there is no dot."""
    return F.when(F.contains(name, F.lit(".")), F.lower(F.substring_index(name, ".", -1))).otherwise("")


def human_size(size: Column) -> Column:
    """Size with two decimals at most, in B, KB, MB or GB (larger units are not used)."""
    size = size.cast("bigint")

    def scaled(unit: int, name: str) -> Column:
        # whole hundredths, halves upwards; integers only, so no rounding noise
        hundredths = div(size * 200 + unit, 2 * unit)
        whole, rest = div(hundredths, 100), hundredths % 100
        digits = (
            F.when(rest == 0, F.lit(""))
            .when(rest % 10 == 0, F.concat(F.lit("."), div(rest, 10).cast("string")))
            .otherwise(F.concat(F.lit("."), F.lpad(rest.cast("string"), 2, "0")))
        )
        return F.concat(whole.cast("string"), digits, F.lit(" " + name))

    return (
        F.when(size < 1024, F.concat(size.cast("string"), F.lit(" B")))
        .when(size < 1024**2, scaled(1024, "KB"))
        .when(size < 1024**3, scaled(1024**2, "MB"))
        .otherwise(scaled(1024**3, "GB"))
    )


def type_label(ext: Column) -> Column:
    return lookup(K.TYPE_LABELS, ext, F.upper(ext))


def target_label(target: Column) -> Column:
    """Label of a conversion target; one without a label is shown as it is."""
    return lookup(K.TARGET_LABELS, target, target)


def conversion_key(source: Column, target: Column) -> Column:
    """Name of the conversion between two extensions, e.g. docx, pdf -> word_to_pdf."""
    return F.concat(lookup(K.KEY_FROM, source, source), F.lit("_to_"), lookup(K.KEY_TO, target, target))


def output_format(conversion_type: Column) -> Column:
    return F.substring_index(conversion_type, "_", -1)


def content_type(fmt: Column, strict: bool = True) -> Column:
    """Media type of an output format.

    ``strict`` first maps conversion tokens such as ``word`` or ``images`` to the format they
    stand for; without it they fall to the default, as they did before.
    """
    fmt = F.lower(fmt)
    if strict:
        fmt = lookup(K.FORMAT_OF_TOKEN, fmt, fmt)
    return lookup(K.CONTENT_TYPES, fmt, F.lit(K.DEFAULT_CONTENT_TYPE))


def download_name(media_type: Column, strict: bool = True) -> Column:
    """``converted.<ext>``. Without ``strict`` html, csv, svg and ico results are called .pdf."""
    known = K.DOWNLOAD_EXTENSIONS | (K.MORE_DOWNLOAD_EXTENSIONS if strict else {})
    return F.concat(F.lit("converted."), lookup(known, media_type, F.lit(K.DEFAULT_DOWNLOAD_EXTENSION)))


def result_name(name: Column, target: Column) -> Column:
    base = F.regexp_replace(F.when(name == "", "file").otherwise(name), r"\.[^.]+\z", "")
    return F.concat(base, F.lit("_converted."), lookup(K.RESULT_EXTENSIONS, target, target))


def sniff_signature(content: Column, ext: Column) -> Column:
    """Is the content non-empty and does it start as its extension demands?"""
    start = F.upper(F.hex(F.substring(content, 1, 4)))
    wanted = lookup(K.SIGNATURES, ext)
    return (F.octet_length(content) > 0) & (wanted.isNull() | (start == F.coalesce(wanted, F.lit(""))))


def task_category(description: Column) -> Column:
    """Kind of work a description asks for; plain substrings, first hit wins."""
    text = F.lower(description)
    has = lambda word: F.contains(text, F.lit(word))
    return (
        F.when(has("api") | has("endpoint"), "api")
        .when(has("form"), "form")
        .when(has("auth") | has("login"), "auth")
        .otherwise("generic")
    )


def queue_for(operation: Column) -> Column:
    return lookup(K.QUEUES, operation)


def archive_path(path: Column, kind: str, root: str = "99-archive") -> Column:
    """Where a file is moved: one flat folder per kind (``tombstones`` or ``duplicates``)."""
    return F.concat(F.lit(f"{root}/{kind}/"), F.replace(path, F.lit("/"), F.lit("__")))


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def age_hours(mtime: Column, now: Column) -> Column:
    return (_micros(now) - _micros(mtime)) / F.lit(3.6e9)


def time_ago(ts: Column, now: Column) -> Column:
    """Rough distance: just now, minutes, hours, yesterday, days."""
    seconds = div(_micros(now) - _micros(ts), 1_000_000)
    return (
        F.when(seconds < 60, "just now")
        .when(seconds < 3600, F.concat(div(seconds, 60).cast("string"), F.lit(" minutes ago")))
        .when(seconds < 86400, F.concat(div(seconds, 3600).cast("string"), F.lit(" hours ago")))
        .when(seconds < 2 * 86400, "yesterday")
        .otherwise(F.concat(div(seconds, 86400).cast("string"), F.lit(" days ago")))
    )


def is_stale(ts: Column, now: Column, days: int = 7) -> Column:
    return _micros(now) - _micros(ts) >= F.lit(days * 86_400_000_000)


def valid_artifact_name(name: Column) -> Column:
    """``{phase-id}-{descriptive-name}.{ext}``, e.g. 02a-architecture-overview.md"""
    return name.rlike(r"^[0-9]{2}[a-z]?-[a-z0-9]+(-[a-z0-9]+)*\.[a-z0-9]+\z")


def preview(text: Column, n: int = 500) -> Column:
    return F.substring(text, 1, n)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)
