"""WARC derivatives: metadata and plain-text conversion records of responses.

Every response record gives two records that name it in WARC-Refers-To: a ``metadata`` record
with its status, headers, digests, title and link count as warc-fields, and a ``conversion`` record
with the plain text of its HTML or other text. Chunks, gzip and deflate are undone first; payloads of other media types, and
such as cannot be unpacked, have metadata only, with the reason. Records of other types (requests, say) give nothing. Both keep the response's target URI and date; record ids are
name-based UUIDs of the source's id, so a repeated run gives the same records, and the metadata record names its
conversion in WARC-Concurrent-To. Digests are SHA-1 in base 32, as archives write them.

A record that cannot be read gives the two records all the same, with ``source-status: unreadable`` and an
empty text; null ids, URLs and bodies count as empty. Repeated responses give repeated records. Bodies of any length
are converted whole, in time that grows with their length; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import in_batches

VERSION, CRLF = "WARC/1.1", "\r\n"
#: Captured pages carry no time of their own; they are dated with this.
DATE = "1970-01-01T00:00:00Z"
HIDDEN = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)")
BREAK = re.compile(r"(?i)</?(?:p|div|br|li|ul|ol|dl|dt|dd|h[1-6]|tr|td|th|table|article|section|nav|header|footer|aside|main|form|pre|blockquote|title|head|body|html)\b[^<>]*>")
TAG = re.compile(r"<[a-zA-Z/!?][^<>]*>")
TITLE = re.compile(r"(?is)<title\b[^<>]*>(.*?)</title")
LINK = re.compile(r"(?i)<a\s[^<>]*?\bhref\s*=")
CHARSET = re.compile(r"(?i)charset\s*=\s*\"?([\w.:-]+)")
#: Media types that are converted as pages; other text types are taken as they are, anything else is not converted.
PAGES = ("text/html", "application/xhtml+xml", "application/xml", "text/xml")
#: Bytes a payload may unpack to.
MOST_BYTES = 256 << 20
COLUMNS = [
    ("record_type", "string"), ("record_id", "string"), ("refers_to", "string"), ("concurrent_to", "string"), ("target_uri", "string"),
    ("date", "string"), ("content_type", "string"), ("source_digest", "string"), ("block_digest", "string"), ("content_length", "long"), ("block", "string"),
]


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def name_id(source: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} {source}')}>"


def one_line(value: str) -> str:
    return " ".join(value.split())


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A serialised record; Content-Length is added, empty values are left out."""
    lines = [VERSION, *(f"{k}: {one_line(v)}" for k, v in headers if v), f"Content-Length: {len(block)}"]
    return (CRLF.join(lines) + CRLF * 2).encode() + block + CRLF.encode() * 2


def read_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of a record; ValueError if it is none."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split(CRLF)
    if not sep or not lines[0].startswith("WARC/"):
        raise ValueError("not a record")
    headers = dict(_fields(lines[1:]))
    n = int(headers["content-length"]) if headers.get("content-length", "").isdigit() else -1
    if not 0 <= n <= len(rest):
        raise ValueError("not a whole record")
    return headers, rest[:n]


def _fields(lines: list[str]) -> list[tuple[str, str]]:
    return [(k.strip().lower(), v.strip()) for k, colon, v in (line.partition(":") for line in lines) if colon]


def response(source: str, url: str, body: bytes, date: str = DATE) -> bytes:
    """A response record of a page that was fetched with status 200."""
    http = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: {len(body)}{CRLF * 2}".encode() + body
    return record(
        [
            ("WARC-Type", "response"), ("WARC-Record-ID", name_id(source, "response")), ("WARC-Date", date), ("WARC-Target-URI", url),
            ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", digest(body)), ("WARC-Block-Digest", digest(http)),
        ],
        http,
    )


def plain_text(page: str) -> str:
    """Text of a page: blocks on lines of their own, single spaces, entities resolved."""
    text = TAG.sub("", BREAK.sub("\n", HIDDEN.sub(" ", page)))
    if "&" in text:
        text = html.unescape(text)
    return "\n".join(line for line in map(one_line, text.split("\n")) if line)


def unchunked(body: bytes) -> bytes:
    """The payload of chunks; ValueError if they are cut short."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        if size < 0 or end + 2 + size > len(body):
            raise ValueError("a chunk is cut short")
        if not size:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


def inflated(body: bytes, bits: int) -> bytes:
    tool = zlib.decompressobj(bits)
    out = tool.decompress(body, MOST_BYTES)
    if tool.unconsumed_tail:
        raise ValueError("too long when unpacked")
    return out


def unpacked(http: dict[str, str], body: bytes) -> bytes:
    """A payload without its transfer and content encodings; ValueError if one is unknown or broken."""
    if "chunked" in http.get("transfer-encoding", "").lower():
        body = unchunked(body)
    for coding in reversed(http.get("content-encoding", "").lower().split(",")):
        coding = coding.strip()
        try:
            if coding in ("gzip", "x-gzip"):
                body = inflated(body, 31)
            elif coding == "deflate":
                try:
                    body = inflated(body, 15)
                except zlib.error:
                    body = inflated(body, -15)
            elif coding not in ("", "identity"):
                raise ValueError(f"unknown encoding {coding}")
        except zlib.error as error:
            raise ValueError(str(error)) from error
    return body


def text_of(http: dict[str, str], body: bytes) -> tuple[str | None, str]:
    """The plain text of a payload, None if it is no text, and the page it is taken from."""
    kind = http.get("content-type", "").split(";")[0].strip().lower()
    if kind and kind not in PAGES and not kind.startswith("text/"):
        return None, ""
    if not kind and b"\0" in body[:1024]:
        return None, ""
    declared = CHARSET.search(http.get("content-type", ""))
    try:
        page = body.decode(declared[1] if declared else "utf-8", "replace")
    except LookupError:
        page = body.decode("utf-8", "replace")
    if kind.startswith("text/") and kind not in PAGES:
        return "\n".join(line for line in map(one_line, page.split("\n")) if line), ""
    return plain_text(page), page


def derive(raw: bytes | None) -> list[tuple]:
    """The metadata and the conversion record of a response, as values of ``COLUMNS``; other records give none.

    A payload that is no text, or cannot be unpacked, has metadata only.
    """
    error = ""
    try:
        headers, block = read_record(raw or b"")
        if headers.get("warc-type", "response").lower() != "response":
            return []
        head, _, body = block.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "replace").split(CRLF)
        status, http = lines[0], _fields(lines[1:])
        try:
            text, page = text_of(dict(http), unpacked(dict(http), body))
        except ValueError as broken:
            text, page, error = None, "", str(broken)
    except ValueError:
        headers, body, text, page, status, http = {}, b"", "", "", "unreadable", []
    source = headers.get("warc-record-id", "")
    converted = text is not None
    text = (text or "").encode("utf-8", "replace")
    title = TITLE.search(page)
    payload = headers.get("warc-payload-digest") or digest(body)
    meta_id, text_id = name_id(source, "metadata"), name_id(source, "conversion")
    fields = [
        ("source-status", status),
        ("source-payload-digest", payload),
        ("source-block-digest", headers.get("warc-block-digest", "")),
        *((f"source-header-{k}", v) for k, v in http),
        ("title", html.unescape(TAG.sub("", title[1])) if title else ""),
        ("links", str(len(LINK.findall(page)))),
        ("payload-error", error),
        ("conversion-digest", digest(text) if converted else ""),
        ("conversion-length", str(len(text)) if converted else ""),
    ]
    meta = "".join(f"{k}: {one_line(v)}{CRLF}" for k, v in fields if v).encode("utf-8", "replace")
    uri, date = headers.get("warc-target-uri", ""), headers.get("warc-date", "")

    def made(kind, own, other, content, block):
        return kind, own, source, other, uri, date, content, payload, digest(block), len(block), block.decode()

    if not converted:
        return [made("metadata", meta_id, "", "application/warc-fields", meta)]
    return [
        made("metadata", meta_id, text_id, "application/warc-fields", meta),
        made("conversion", text_id, "", "text/plain; charset=utf-8", text),
    ]


def serialise(row: dict) -> bytes:
    """The record of a derived row as it stands in an archive file."""
    return record(
        [
            ("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["date"]), ("WARC-Target-URI", row["target_uri"]),
            ("WARC-Refers-To", row["refers_to"]), ("WARC-Concurrent-To", row["concurrent_to"]), ("WARC-Block-Digest", row["block_digest"]), ("Content-Type", row["content_type"]),
        ],
        row["block"].encode(),
    )


def as_responses(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """key and the response record, for a table of fetched pages."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = zip(*(c.to_pylist() for c in batch.columns))
        made = [response(f"{'' if k is None else k} {u or ''}", u or "", (b or "").encode("utf-8", "replace")) for k, u, b in rows]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], [key, "record"])

    rows = pages.select(F.col(key), F.col(url).cast("string").alias("u"), F.col(body).cast("string").alias("b"))
    return in_batches(rows, f"`{key}` {pages.schema[key].dataType.simpleString()}, record binary", work)


def derivatives(responses: DataFrame, key: str = "page_id", raw: str = "record") -> DataFrame:
    """key and the columns of the derived records, two as a rule, for every row of ``responses``."""
    names = [n for n, _ in COLUMNS]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        derived = [derive(x.as_py()) for x in batch.column(1)]
        rows = [r for rs in derived for r in rs]
        kinds = [pa.int64() if k == "long" else pa.string() for _, k in COLUMNS]
        columns = zip(*rows) if rows else [[]] * len(names)
        twice = batch.column(0).take(pa.array([i for i, rs in enumerate(derived) for _ in rs], pa.int64()))
        return pa.RecordBatch.from_arrays([twice, *(pa.array(list(c), k) for c, k in zip(columns, kinds))], [key, *names])

    schema = f"`{key}` {responses.schema[key].dataType.simpleString()}, " + ", ".join(f"{n} {k}" for n, k in COLUMNS)
    return in_batches(responses.select(key, F.col(raw).alias("r")), schema, work)
