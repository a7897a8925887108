"""WARC derivatives: linked metadata and plain-text conversion records for response records.

Every response gives two records. The ``metadata`` record lists, as WARC fields, the response's id,
digests, HTTP status and source headers, the title, the charset that was used and the id of the
conversion. The ``conversion`` record holds the plain text. Both refer to the response
(WARC-Refers-To), keep its target URI and date, and carry the digest of their own block. Ids are
UUIDs derived from the response's id, so a rerun, or a task that is run again, gives the same ones.
The work is done record by record where the response is read; nothing is shuffled.

Defined results: a null block or URI is empty. A block without an HTTP head is taken as the body, with
status 0. A body that cannot be unpacked or decoded is read as far as it goes, with replacement
characters; gzip of several members, zlib and whole raw deflate are unpacked, repeatedly where headers say so. A
charset may stand anywhere in the head. Pages are scanned once, so broken ones take no longer. Responses that are repeated give repeated records. Rows of another type are left out. Other
columns take no part and may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

RECORD = (
    "warc_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, "
    "block_digest string, payload_digest string, block binary"
)
_FIELDS = [x.split()[0] for x in RECORD.split(", ")]
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)\b")
_TO_END = re.compile(r"(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+>")
#: Elements whose content is no text, and how they end.
_HIDDEN = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "noscript", "template")}
#: Elements that end a line of text (fixed list of HTML block elements).
BLOCKS = frozenset((
    "address article aside blockquote body br dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html li main nav ol option p pre section select summary table tbody td tfoot th thead title tr ul"
).split())
_META, _HEAD_END = re.compile(rb"<meta[\s/]", re.I), re.compile(rb"</head|<body[\s>/]", re.I)
_CHARSET = re.compile(rb"charset\s*=\s*[\"']?\s*([A-Za-z0-9_.:-]+)", re.I)
_TITLE, _TITLE_END = re.compile(r"<title\b", re.I), re.compile(r"</title", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def derived_id(source: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source}#{kind}')}>"


def split_http(block: bytes) -> tuple[int, list[tuple[str, str]], bytes]:
    """Status, headers as they were sent, and body."""
    if not block.startswith(b"HTTP/"):
        return 0, [], block
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")
    status = re.match(r"HTTP/\S+ (\d{3})", lines[0])
    headers: list[tuple[str, str]] = []
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and headers:  # a folded line goes on
            headers[-1] = (headers[-1][0], f"{headers[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            headers.append((name.strip(), value.strip()))
    return int(status[1]) if status else 0, headers, body


def _unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while m := re.compile(rb"([0-9A-Fa-f]+)[^\r\n]*\r\n").match(body, at):
        size = int(m[1], 16)
        if not size:
            break
        out.append(body[m.end() : m.end() + size])
        at = m.end() + size + 2
    return b"".join(out) if out else body


def _unpacked(body: bytes) -> bytes:
    """What can be read of a gzip, zlib or raw deflate body, member after member; the body itself if nothing can."""
    out = []
    while body:
        for window in (47, -15) if not out else (47,):
            reader, read = zlib.decompressobj(window), []
            try:
                for at in range(0, len(body), 1 << 16):
                    read.append(reader.decompress(body[at : at + (1 << 16)]))
                    if reader.eof:
                        break
                read.append(reader.flush())
            except zlib.error:
                pass
            if window < 0 and not reader.eof:
                read = []  # anything may look like the start of raw deflate
            if any(read) or reader.eof:
                break
        if not any(read) and not reader.eof:
            break
        out += read
        if not reader.eof:
            break
        body = (reader.unused_data + body[at + (1 << 16) :]).lstrip(b"\0")
    return b"".join(out) if out else body


def _declared(body: bytes) -> str | None:
    """Charset of the first meta element in the head that names one."""
    end = _HEAD_END.search(body)
    head, at = body[: end.start()] if end else body, 0
    while m := _META.search(head, at):
        at = head.find(b">", m.end())
        found = _CHARSET.search(head, m.end(), at if at >= 0 else len(head))
        if found or at < 0:
            return found[1].decode() if found else None
    return None


def decoded(headers: list[tuple[str, str]], body: bytes) -> tuple[str, str]:
    """Text of the body and the charset used."""
    known = {n.lower(): v for n, v in headers}
    if "chunked" in known.get("transfer-encoding", "").lower():
        body = _unchunked(body)
    for packing in reversed(known.get("content-encoding", "").lower().split(",")):
        if packing.strip() in ("gzip", "x-gzip", "deflate"):
            body = _unpacked(body)
    named = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", known.get("content-type", ""), re.I)
    charset = named[1] if named else _declared(body) or "utf-8"
    try:
        return body.decode(charset, "replace"), charset.lower()
    except LookupError:
        return body.decode("utf-8", "replace"), "utf-8"


def plain_text(page: str) -> str:
    """Text of an HTML page, a line per block element, without scripts, styles and comments.

    One pass from the left. A tag ends at the first ``>`` outside quotes; once a quote has turned out to have no end,
    at the first ``>`` of all. What has no ``>`` after it is text.
    """
    out, at, quotes = [], 0, True
    while (start := page.find("<", at)) >= 0:
        out.append(page[at:start])
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else len(page)
            continue
        tag = _TAG.match(page, start)
        if not tag and page[start + 1 : start + 2] not in ("!", "?", "/"):
            out.append("<")
            at = start + 1
            continue
        end = page.find(">", start)
        if end < 0:
            at = start
            break
        name = tag[2].lower() if tag else ""
        if name in _HIDDEN and not tag[1]:
            closed = _HIDDEN[name].search(page, end + 1)
            at = closed.end() if closed else len(page)
            continue
        if tag and quotes:
            whole = _TO_END.match(page, tag.end())
            quotes = whole is not None
            end = whole.end() - 1 if whole else end
        if name in BLOCKS:
            out.append("\n")
        at = end + 1
    out.append(page[at:])
    lines = html.unescape("".join(out)).replace("\xa0", " ").split("\n")
    return "\n".join(t for line in lines if (t := " ".join(line.split())))


def title_of(page: str) -> str:
    opened = _TITLE.search(page)
    begin = page.find(">", opened.end()) if opened else -1
    closed = _TITLE_END.search(page, begin) if begin >= 0 else None
    return plain_text(page[begin + 1 : closed.start()]) if closed else ""


def _field(value: str) -> str:
    return " ".join(value.split())


def derive_one(record_id: str, uri: str, date: str, block: bytes, block_digest: str | None, payload_digest: str | None) -> list[tuple]:
    status, headers, body = split_http(block)
    page, charset = decoded(headers, body)
    kind = next((v for n, v in headers if n.lower() == "content-type"), "")
    is_html = "html" in kind.lower() or not kind and page.lstrip()[:1] == "<"
    text = plain_text(page) if is_html else page
    title = title_of(page) if is_html else ""
    of_block, of_payload = block_digest or digest(block), payload_digest or digest(body)
    converted, described = derived_id(record_id, "conversion"), derived_id(record_id, "metadata")
    fields = [
        ("source-record-id", record_id), ("source-block-digest", of_block), ("source-payload-digest", of_payload),
        ("http-status", str(status)), *((f"http-header-{n.lower()}", v) for n, v in headers),
        ("charset-detected", charset), ("title", title), ("conversion-record-id", converted),
    ]
    about = "".join(f"{n}: {_field(v)}\r\n" for n, v in fields).encode("utf-8", "replace")
    body_text = text.encode("utf-8", "replace")
    return [
        ("metadata", described, record_id, uri, date, "application/warc-fields", digest(about), of_payload, about),
        ("conversion", converted, record_id, uri, date, "text/plain; charset=utf-8", digest(body_text), of_payload, body_text),
    ]


def derivatives(responses: DataFrame) -> DataFrame:
    """Metadata and conversion records of the ``response`` rows of a table of WARC records (schema RECORD)."""

    def rows(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200).to_pydict()
                out = [
                    new
                    for rid, uri, date, block, b, p in zip(*(part[c] for c in ("record_id", "target_uri", "warc_date", "block", "block_digest", "payload_digest")))
                    for new in derive_one(rid or "", uri or "", date or "", block or b"", b, p)
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "block" else pa.string()) for n, c in zip(_FIELDS, zip(*out))], _FIELDS)

    wanted = responses.filter("warc_type = 'response'").select("record_id", "target_uri", "warc_date", "block", "block_digest", "payload_digest")
    return wanted.mapInArrow(rows, RECORD)


def responses_of(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records for a table of pages (page_id, url, html), natively."""
    body = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    name = F.md5(F.concat_ws("\n", F.col("page_id").cast("string"), F.coalesce(F.col("url"), F.lit("")), F.md5(body)))
    dashed = F.concat_ws("-", *[F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return pages.select(
        F.lit("response").alias("warc_type"), F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">")).alias("record_id"),
        F.lit(None).cast("string").alias("refers_to"), F.coalesce(F.col("url"), F.lit("")).alias("target_uri"), F.lit(date).alias("warc_date"),
        F.lit("application/http; msgtype=response").alias("content_type"), F.lit(None).cast("string").alias("block_digest"),
        F.lit(None).cast("string").alias("payload_digest"), F.concat(F.encode(head, "utf-8"), body).alias("block"),
    )


# ---------------------------------------------------------------- files


def to_bytes(r: dict) -> bytes:
    head = [
        ("WARC-Type", r["warc_type"]), ("WARC-Record-ID", r["record_id"]), ("WARC-Refers-To", r["refers_to"]), ("WARC-Target-URI", r["target_uri"]),
        ("WARC-Date", r["warc_date"]), ("WARC-Block-Digest", r["block_digest"]), ("WARC-Payload-Digest", r["payload_digest"]),
        ("Content-Type", r["content_type"]), ("Content-Length", str(len(r["block"] or b""))),
    ]
    lines = "".join(f"{n}: {v}\r\n" for n, v in head if v)
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "replace") + b"\r\n" + (r["block"] or b"") + b"\r\n\r\n"


def parse_bytes(data: bytes) -> Iterator[dict]:
    """Records of an uncompressed WARC file; a broken tail ends it."""
    at = 0
    while at < len(data) and (end := data.find(b"\r\n\r\n", at)) > 0:
        lines = data[at:end].decode("utf-8", "replace").lstrip().split("\r\n")
        known = {n.strip().lower(): v.strip() for n, _, v in (x.partition(":") for x in lines[1:])}
        size = int(known.get("content-length") or 0)
        block = data[end + 4 : end + 4 + size]
        if len(block) < size:
            return
        yield {
            "warc_type": known.get("warc-type"), "record_id": known.get("warc-record-id"), "refers_to": known.get("warc-refers-to"),
            "target_uri": known.get("warc-target-uri"), "warc_date": known.get("warc-date"), "content_type": known.get("content-type"),
            "block_digest": known.get("warc-block-digest"), "payload_digest": known.get("warc-payload-digest"), "block": block,
        }
        at = end + 4 + size + 4


def write_warc(records: DataFrame, path: str, records_per_file: int = 50_000) -> None:
    """Files of WARC records, whose blocks must be UTF-8 as those of derivatives are."""

    def rows(batches):
        for batch in batches:
            out = [to_bytes(r)[:-1].decode("utf-8") for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    # the line end that the writer adds is the record's last byte
    records.select(*_FIELDS).mapInArrow(rows, "value string").write.option("lineSep", "\n").option("maxRecordsPerFile", records_per_file).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the uncompressed WARC files under ``path``; a file is read by one task."""

    def rows(batches):
        for batch in batches:
            for content in batch.column("content"):
                held = []
                for record in parse_bytes(content.as_py()):
                    held.append(record)
                    if len(held) == 500:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    schema = pa.schema([(n, pa.binary() if n == "block" else pa.string()) for n in _FIELDS])
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(rows, RECORD)
