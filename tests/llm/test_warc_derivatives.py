import base64
import gzip
import hashlib
import zlib
from html.parser import HTMLParser

import pytest

from barloom.llm import warc_derivatives as W
from barloom.llm.common import table
from barloom.llm.queries import op8_warc_derivatives

NAMES = [n for n, _ in W.COLUMNS]


def sha(block):
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def derived(raw):
    meta, text = (dict(zip(NAMES, r)) for r in W.derive(raw))
    return meta, text


def test_records_are_linked_and_read_back():
    page = "<html><head><title>A &amp; B</title></head><body><p>One  two<a href='x'>three</a></p><script>no()</script>end&lt;</body></html>"
    raw = W.response("1", "http://a.org/x", page.encode())
    source, block = W.read_record(raw)
    meta, text = derived(raw)
    for d in (meta, text):
        headers, body = W.read_record(W.serialise(d))
        assert headers["warc-refers-to"] == source["warc-record-id"] and headers["warc-target-uri"] == "http://a.org/x"
        assert headers["warc-date"] == source["warc-date"] and headers["warc-type"] == d["record_type"]
        assert body.decode() == d["block"] and headers["warc-block-digest"] == sha(body) and len(body) == d["content_length"]
        assert d["source_digest"] == sha(page.encode())
    fields = dict(line.split(": ", 1) for line in meta["block"].strip().split("\r\n"))
    assert fields["title"] == "A & B" and fields["links"] == "1" and fields["source-status"] == "HTTP/1.1 200 OK"
    assert fields["source-header-content-type"] == "text/html; charset=utf-8" and fields["source-payload-digest"] == sha(page.encode())
    assert fields["source-block-digest"] == sha(block) and fields["conversion-digest"] == text["block_digest"]
    assert meta["concurrent_to"] == text["record_id"] and text["block"] == "A & B\nOne twothree\nend<"
    assert W.derive(raw) == W.derive(raw)


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain", "plain"),
        ("a<br>b<!-- c --><p>d", "a\nb\nd"),
        ("<style>x</style>y<script>never closed", "y"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("x<!-- open", "x"),
        ("&eacute;&#x41;&nbsp;b", "éA b"),
        ("<" * 100_000, "<" * 100_000),
    ],
)
def test_plain_text(page, text):
    assert W.plain_text(page) == text


def test_charset_of_the_source():
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=ISO-8859-1\r\n\r\n".encode() + "Größe".encode("latin-1")
    raw = W.record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>")], http)
    assert derived(raw)[1]["block"] == "Größe"
    assert derived(raw.replace(b"ISO-8859-1", b"nowhere-88"))[1]["block"].startswith("Gr")


@pytest.mark.parametrize("raw", [None, b"", b"junk", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort", b"WARC/1.1\r\nContent-Length: x\r\n\r\n"])
def test_what_cannot_be_read_is_reported(raw):
    meta, text = derived(raw)
    assert "source-status: unreadable" in meta["block"] and text["block"] == ""


def test_query(spark, sf_dir):
    rows = op8_warc_derivatives(spark, sf_dir).collect()
    pages = {r.page_id: r for r in table(spark, sf_dir, "pages").collect()}
    assert len(rows) == 2 * len(pages)
    for r in rows:
        page = pages[r.page_id]
        assert r.target_uri == page.url and r.source_digest == sha(page.html.encode()) and r.block_digest == sha(r.block.encode())
        if r.record_type == "conversion":
            assert r.block == W.plain_text(page.html)


def test_edges(spark):
    rows = [(1, None, None), (2, "http://b.org/", ""), (2, "http://b.org/", ""), (None, "http://c.org/\r\nX: y", "<p>" + "long " * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS record", "'y' AS block", "1 AS u")
    out = W.derivatives(W.as_responses(pages)).collect()
    assert len(out) == 8 and {r.record_type for r in out} == {"metadata", "conversion"}
    assert [r.target_uri for r in out if r.page_id is None] == ["http://c.org/ X: y"] * 2
    assert W.derivatives(W.as_responses(pages.where("false"))).count() == 0


def http_record(kind, headers, body, status="HTTP/1.1 200 OK"):
    http = "\r\n".join([status, *(f"{k}: {v}" for k, v in headers)]).encode() + b"\r\n\r\n" + body
    return W.record([("WARC-Type", kind), ("WARC-Record-ID", f"<urn:{kind}>"), ("WARC-Target-URI", "http://a/")], http)


class Extractor(HTMLParser):
    """Text of a page by the standard library's parser, blocks and scripts as the operator has them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "noscript", "template")
        self.parts.append("" if self.hidden else "\n" if W.BREAK.fullmatch(f"<{tag}>") else "")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "noscript", "template") and self.hidden > 0
        self.parts.append("\n" if W.BREAK.fullmatch(f"</{tag}>") else "")

    def handle_data(self, data):
        self.parts.append(" " if self.hidden else data)


def extracted(page):
    parser = Extractor()
    parser.feed(page)
    parser.close()
    return "\n".join(line for line in (" ".join(x.split()) for x in "".join(parser.parts).split("\n")) if line)


def test_text_as_another_extractor_has_it(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = W.derivatives(W.as_responses(spark.read.parquet(f"{sf_dir}/pages.parquet"))).where("record_type = 'conversion'").collect()
    words = lambda text: text.split()
    same = sum(words(r.block) == words(extracted(pages[r.page_id] or "")) for r in rows)
    assert same >= 0.98 * len(rows) > 0, (same, len(rows))


def test_encodings_types_and_other_records():
    page = "<html><body><p>Grüße &amp; so</p></body></html>".encode()
    chunked = b"".join(b"%x;x=y\r\n%s\r\n" % (len(c), c) for c in (page[:7], page[7:])) + b"0\r\n\r\n"
    html_type = ("Content-Type", "text/html; charset=utf-8")
    raw = zlib.compressobj(wbits=-15)
    cases = [
        ([html_type, ("Transfer-Encoding", "chunked")], chunked),
        ([html_type, ("Content-Encoding", "gzip")], gzip.compress(page)),
        ([html_type, ("Content-Encoding", "deflate")], zlib.compress(page)),
        ([html_type, ("Content-Encoding", "deflate")], raw.compress(page) + raw.flush()),
        ([html_type, ("Content-Encoding", "gzip"), ("Transfer-Encoding", "Chunked")], b"%x\r\n%s\r\n0\r\n\r\n" % (len(gzip.compress(page)), gzip.compress(page))),
        ([("Content-Type", "application/xhtml+xml")], page),
        ([], page),
    ]
    for headers, body in cases:
        meta, text = W.derive(http_record("response", headers, body))
        assert text[-1] == "Grüße & so" and meta[3] == text[1], headers
    assert W.derive(http_record("response", [("Content-Type", "text/plain")], b"a <b> c\n\n d"))[1][-1] == "a <b> c\nd"
    for headers, body in (([("Content-Type", "image/png")], b"\x89PNG"), ([], b"\0\1"), ([html_type, ("Content-Encoding", "gzip")], b"no"), ([html_type, ("Content-Encoding", "br")], page), ([("Transfer-Encoding", "chunked")], b"ff\r\nshort")):
        found = W.derive(http_record("response", headers, body))
        assert [f[0] for f in found] == ["metadata"] and found[0][3] == "" and "source-status: HTTP/1.1 200 OK" in found[0][-1]
    assert W.derive(http_record("request", [], b"", "GET / HTTP/1.1")) == []
    assert [f[0] for f in W.derive(b"junk")] == ["metadata", "conversion"]
