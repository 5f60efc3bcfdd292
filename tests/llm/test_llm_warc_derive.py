import gzip
import hashlib
import time
import zlib
from collections import Counter

import pytest
import zstandard
from corpus_cases import SF, with_clashes

from sysledger.llm import warc_derive
from sysledger.llm.warc_derive import Page, derivatives, derive, digest, parse, plain_text, response_records, serialise


def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


def headers(record):
    head, _, rest = bytes(record).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    assert lines[0] == "WARC/1.1"
    return dict(x.split(": ", 1) for x in lines[1:]), rest


def test_records_are_linked_and_whole(spark):
    source = {r.page_id: bytes(r.record) for r in response_records(pages(spark)).collect()}
    rows = derivatives(response_records(pages(spark))).collect()
    assert Counter((r.page_id, r.warc_type) for r in rows) == Counter((i, k) for i in source for k in ("metadata", "conversion"))
    assert len({r.record_id for r in rows}) == len(rows)
    for r in rows:
        warc, _, _, payload = parse(source[r.page_id])
        own, rest = headers(r.record)
        block = rest[: int(own["Content-Length"])]
        assert rest[len(block):] == b"\r\n\r\n"
        assert own["WARC-Refers-To"] == r.refers_to == warc["warc-record-id"]
        assert own["WARC-Target-URI"] == r.target_uri == warc["warc-target-uri"]
        assert own["WARC-Date"] == warc["warc-date"]
        assert own["WARC-Source-Payload-Digest"] == warc["warc-payload-digest"] == digest(payload)
        assert own["WARC-Source-Block-Digest"] == warc["warc-block-digest"]
        assert own["WARC-Block-Digest"] == r.block_digest == digest(block)
        assert block.decode() == r.block and r.content_length == len(block) and r.digest_ok
        if r.warc_type == "metadata":
            assert "http-header: Content-Type: text/html" in r.block
        else:
            assert "<p>" not in r.block and "track(" not in r.block


def test_a_second_run_writes_the_same(spark):
    once = {(r.record_id, hashlib.sha256(r.record).hexdigest()) for r in derivatives(response_records(pages(spark))).collect()}
    again = {(r.record_id, hashlib.sha256(r.record).hexdigest()) for r in derivatives(response_records(pages(spark).repartition(5))).collect()}
    assert once == again


def test_plain_text():
    assert plain_text("<html><head><title>A &amp; B</title><style>p{}</style></head><body><!-- no --><p>x  y<br>z</p><script>var t='</p>'</script>"
                      "<div>1 &lt; 2</div></body></html>") == "A & B\nx y\nz\n1 < 2"
    assert plain_text("") == "" and plain_text("<p>open <b>tags") == "open tags"
    assert plain_text("a < b and c > d") == "a < b and c > d"


def test_pages_without_optional_tags():
    assert plain_text("<html><head><title>x</title><h1>Title</h1><p>All of the text.</p></html>") == "x\nTitle\nAll of the text."
    assert plain_text("<head><meta charset=utf-8>\n<link rel=a href=b><title>x</title><base href=c><p>text</p>") == "x\ntext"
    assert plain_text("<head><title>x</title>Bare text<p>more</p>") == "x\nBare text\nmore"
    assert plain_text("<head><title>x</title><style>a{}</style><script>f()</script><body><p>text") == "x\ntext"
    assert plain_text("<header>top</header><p>text") == "top\ntext"
    assert plain_text("<head><title>x") == "x"


def response(payload, http="HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=iso-8859-1", **extra):
    block = http.encode() + b"\r\n\r\n" + payload
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>"), ("WARC-Target-URI", "http://e.org/"), ("WARC-Date", "2024-01-01T00:00:00Z")]
    return serialise([*fields, *extra.items()], block)


def test_charsets_digests_and_folded_headers():
    meta, conversion = derive(response("<p>caf\xe9".encode("latin-1"), **{"WARC-Payload-Digest": "sha1:WRONG"}))
    assert conversion[7] == "café" and conversion[6] is False
    assert "charset: iso-8859-1" in meta[7] and "charset-from: header" in meta[7]
    meta, conversion = derive(response("<meta charset=nonsense><p>ü".encode(), http="HTTP/1.0 404 Gone\r\nX: a\r\n b"))
    assert conversion[7] == "ü" and conversion[6] is None
    assert "status: HTTP/1.0 404 Gone" in meta[7] and "http-header: X: a b" in meta[7]


def test_edges(spark):
    rows = [(1, None, None), (2, "http://e.org/", ""), (2, "http://e.org/", ""), (None, "http://e.org/n", "<p>x</p>"), (3, "u", "<p>" + "long " * 300_000)]
    df = with_clashes(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = derivatives(response_records(df)).collect()
    assert Counter(r.page_id for r in got) == Counter({1: 2, 2: 4, None: 2, 3: 2})
    assert {r.block for r in got if r.page_id in (1, 2) and r.warc_type == "conversion"} == {""}
    assert derivatives(response_records(df.limit(0))).collect() == []
    bad = spark.createDataFrame([(1, None), (2, bytearray(b"")), (3, bytearray(b"no record")), (4, bytearray(serialise([("WARC-Type", "request")], b"GET")))],
                                "page_id long, record binary")
    assert derivatives(bad).collect() == []


HTML = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"


@pytest.mark.parametrize("piece", ["<p ", "<title ", "<a href=", "<html lang", "<!-- ", "<script>", "</", "<a x=\"", "<a x='", "<head>", "<style", "< ", "&#",
                                   "<p x=\"'>", "<a href='\"", "<title>", "</title", "<meta "])
def test_hostile_pages_take_linear_time(piece):
    start = time.time()
    Page(piece * (10_000_000 // len(piece))).text()
    warc_derive._meta_charset((piece * (10_000_000 // len(piece))).encode())
    assert time.time() - start < 8


def test_quotes_and_odd_tags():
    assert plain_text("<a title=\"x > y\" href=z>link</a>") == "link"
    assert plain_text("<p title='a\"b>c'>t") == "t" and plain_text("<p title=it's>t<b>u") == "tu"
    assert plain_text("<p title=\"open>t<p>u") == "t\nu"  # the quote never ends: an ordinary character
    assert plain_text("1 <2 and 3> 1, a<b>c</b>") == "1 <2 and 3> 1, ac"
    assert plain_text("x<!doctype html><?php echo?>y</>z<!-- <p> --><br/>w") == "xyz\nw"
    assert plain_text("a<SCRIPT>if (a</b>c) '</p>'</Script >b<style>x") == "ab"
    assert plain_text("<title>one</title><p>two<svg><title>three</title></svg>") == "one\ntwo\nthree"
    page = Page("<HTML LANG='pt-BR'><a name=x><a class=\"a\" HREF = 'y'>z</a><a data-href=q></a><link href=u>")
    assert (page.links, page.language) == (1, "pt-br")


def test_transfer_and_content_codings():
    text = "<title>T</title><p>" + "é text " * 5000
    raw = text.encode()
    plain = derive(response(raw, http=HTML))[1][7]
    assert plain.startswith("T\né text")
    codings = {"gzip": gzip.compress(raw), "x-gzip": gzip.compress(raw), "deflate": zlib.compress(raw), "zstd": zstandard.compress(raw),
               "identity": raw, "deflate, gzip": gzip.compress(zlib.compress(raw)), "GZIP": gzip.compress(raw[:99]) + gzip.compress(raw[99:])}
    for name, body in codings.items():
        assert derive(response(body, http=f"{HTML}\r\nContent-Encoding: {name}"))[1][7] == plain, name
    bare = zlib.compressobj(wbits=-15)
    assert derive(response(bare.compress(raw) + bare.flush(), http=f"{HTML}\r\nContent-Encoding: deflate"))[1][7] == plain
    zipped = gzip.compress(raw)
    chunks = b"".join(b"%x;note=1\r\n%s\r\n" % (len(c), c) for c in (zipped[:10], zipped[10:500], zipped[500:])) + b"0\r\nTrailer: x\r\n\r\n"
    meta, conversion = derive(response(chunks, http=f"{HTML}\r\nTransfer-Encoding: chunked\r\nContent-Encoding: gzip",
                                       **{"WARC-Payload-Digest": digest(zipped)}))
    assert conversion[7] == plain and conversion[6] is True and "undone: chunked" in meta[7] and "undone: gzip" in meta[7]
    assert derive(response(raw, http=f"{HTML}\r\nTransfer-Encoding: chunked"))[1][7] == plain  # stored without its chunks
    cut = derive(response(zipped[:-30], http=f"{HTML}\r\nContent-Encoding: gzip"))[1][7]
    assert cut and plain.startswith(cut[:100])
    for name, body in (("br", raw), ("gzip", b"no gzip"), ("zstd", b"no zstd"), ("made-up", raw)):
        records = derive(response(body, http=f"{HTML}\r\nContent-Encoding: {name}"))
        assert [r[1] for r in records] == ["metadata"] and f"not-undone: {name}" in records[0][7]


def test_a_bomb_is_not_expanded(monkeypatch):
    monkeypatch.setattr(warc_derive, "MAX_EXPANDED", 1000)
    for coding, pack in (("gzip", gzip.compress), ("zstd", zstandard.compress)):
        assert len(derive(response(pack(b"x" * 1001), http=f"{HTML}\r\nContent-Encoding: {coding}"))) == 1
        assert derive(response(pack(b"x" * 1000), http=f"{HTML}\r\nContent-Encoding: {coding}"))[1][7] == "x" * 1000


def test_media_types():
    def http(kind):
        return "HTTP/1.1 200 OK" + (f"\r\nContent-Type: {kind}" if kind else "")

    png = b"\x89PNG\r\n\x1a\n<p>"
    assert [r[1] for r in derive(response(png, http=http("image/png")))] == ["metadata"]
    assert [r[1] for r in derive(response(b"%PDF", http=http("application/pdf")))] == ["metadata"]
    text = b"a <b> c\r\n  d\n\ne &amp;"
    assert derive(response(text, http=http("text/plain")))[1][7] == "a <b> c\n  d\n\ne &amp;"
    assert derive(response(text, http=http("Application/JSON; x=y")))[1][7].startswith("a <b> c")
    assert derive(response(b" <p>x", http=http(None)))[1][7] == "x" and derive(response(b"x <p>", http=http(None)))[1][7] == "x <p>"
    assert derive(response(b"", http=http(None)))[1][7] == "" and derive(response(b"<p>x", http=http("application/xhtml+xml")))[1][7] == "x"
