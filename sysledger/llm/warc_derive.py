"""WARC derivatives: metadata and plain-text conversion records of responses.

A response record (one row, the record's bytes) gives up to two records, linked
to it by WARC-Refers-To and carrying its target URI and date:

- ``metadata``: ``application/warc-fields`` with what was found about the
  response: status, media type, codings that were undone, charset and how it was
  known, language, title, number of links, digest of the payload, and the
  source's HTTP headers, each under ``http-header``;
- ``conversion``: ``text/plain``, the text of a page or of another text. Its
  WARC-Source-* headers keep the response's block and payload digest. Responses
  without text (images and other media types that are not text, codings that
  cannot be undone) have metadata alone.

Record ids are UUIDs made from the response's id and the record's type, so a
second run, or a task that is run again, writes the same ids. Each record has
the digest and length of its own block; the response's own digests are passed
on as they are, and ``digest_ok`` says whether its payload digest holds, for
the payload as it is stored or without its chunks.

Payloads: ``Transfer-Encoding: chunked`` and the content codings gzip, deflate
and zstd are undone, what a cut-off stream holds is kept, a stream that expands
beyond ``MAX_EXPANDED`` is not undone. HTML and XHTML (and payloads without
media type that begin with ``<``) are read as pages, other texts as they are.

A page is read by one pass from tag to tag; every search for the end of
something goes on from where the last one ended, or is not made again once it
has found nothing, so the time is linear in the page whatever it holds. Quoted
attribute values may hold ``>``. Scripts, styles, templates, comments and the
head but its title are left out (a head without end tag ends where content
begins); block elements end lines; character references are resolved; white
space runs become one space; empty lines go. A tag, comment or script that
never ends takes the rest of the page.

Defined cases: null or empty bytes, and bytes that are no response record,
give no records; a response without payload gives a conversion with an empty
block; undecodable bytes become replacement characters; responses that repeat
are derived each; an empty table gives an empty result; other columns are not
read.
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
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

SCHEMA = ("page_id long, record_id string, warc_type string, refers_to string, target_uri string, "
          "block_digest string, content_length long, digest_ok boolean, block string, record binary")

# Elements whose content is no text of the page, elements that may
# stand in a head, and elements that begin a new line.
SKIPPED = {"script", "style", "template", "noscript"}
HEAD_ELEMENTS = {"meta", "link", "base", "basefont", "bgsound", "title", *SKIPPED}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "br", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section", "table", "tbody", "td", "tfoot",
    "th", "thead", "title", "tr", "ul"}
PAGE_TYPES = {"text/html", "application/xhtml+xml"}
TEXT_TYPES = {"application/json", "application/xml", "application/javascript", "application/ld+json", "application/rss+xml", "application/atom+xml"}
MAX_EXPANDED = 1 << 28

TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
TAG_END = re.compile(r"""=\s*(["'])|>""")
SPACE = re.compile(r"[^\S\n]+")
HREF = re.compile(r"(?:^|[\s\"'/])href\s*=", re.I)
LANGUAGE = re.compile(r"(?:^|[\s\"'/])lang\s*=\s*[\"']?([A-Za-z0-9-]+)", re.I)
META_CHARSET = re.compile(rb"\bcharset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)
HEADER_CHARSET = re.compile(r"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)
CRLF = b"\r\n"


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def serialise(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + CRLF * 2 + block + CRLF * 2


def _headers(raw: bytes) -> list[tuple[str, str]]:
    """Header lines; continued lines are joined."""
    out: list[tuple[str, str]] = []
    for line in raw.decode("utf-8", "replace").splitlines():
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            k, _, v = line.partition(":")
            out.append((k.strip(), v.strip()))
    return out


def parse(record: bytes | None) -> tuple[dict[str, str], str, list[tuple[str, str]], bytes] | None:
    """(WARC headers by lower-case name, status line, HTTP headers, payload)
    of a response record, or None."""
    if not record or not record.startswith(b"WARC/"):
        return None
    head, _, rest = record.partition(CRLF * 2)
    warc = {k.lower(): v for k, v in _headers(head.partition(CRLF)[2])}
    if warc.get("warc-type") != "response" or not warc.get("content-length", "").isdigit():
        return None
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(CRLF * 2)
    status, _, lines = http.partition(CRLF)
    return warc, status.decode("latin-1"), _headers(lines), payload


def header(http: list[tuple[str, str]], name: str) -> str | None:
    return next((v for k, v in http if k.lower() == name), None)


def dechunked(body: bytes) -> bytes:
    """The data of a chunked body; what a cut-off one holds."""
    out, at = [], 0
    while (end := body.find(CRLF, at)) >= 0:
        try:
            size = int(body[at:end].partition(b";")[0].strip() or b"x", 16)
        except ValueError:  # no chunk here: the body was stored without its chunks
            return body if not out else b"".join(out)
        if size <= 0:
            break
        out.append(body[end + 2:end + 2 + size])
        at = end + 2 + size + 2
    return b"".join(out) if out or at else body


def expanded(body: bytes, coding: str) -> bytes | None:
    """``body`` without its content coding; None if that cannot be undone."""
    try:
        if coding in ("gzip", "x-gzip", "deflate"):
            # 32 takes gzip and zlib heads; some servers send deflate without any
            raw = coding == "deflate" and not (body[:1] and body[0] & 0x0F == 8 and int.from_bytes(body[:2], "big") % 31 == 0)
            out, rest = [], body
            left = MAX_EXPANDED + 1
            while rest and left > 0:  # gzip members may follow each other
                stream = zlib.decompressobj(-zlib.MAX_WBITS if raw else zlib.MAX_WBITS | 32)
                try:
                    out.append(stream.decompress(rest, left))
                except zlib.error:
                    if not out:
                        raise
                    break  # not a further member
                left -= len(out[-1])
                rest = stream.unused_data if stream.eof else b""
            whole = b"".join(out)
        elif coding == "zstd":
            whole = zstandard.ZstdDecompressor().stream_reader(body).read(MAX_EXPANDED + 1)
        else:
            return None
    except (zlib.error, zstandard.ZstdError):
        return None
    return whole if len(whole) <= MAX_EXPANDED else None


def content(payload: bytes, http: list[tuple[str, str]]) -> tuple[bytes | None, list[str]]:
    """The payload without transfer and content codings (None if they cannot be
    undone) and the names of those undone."""
    undone = []
    if "chunked" in (header(http, "transfer-encoding") or "").lower():
        payload = dechunked(payload)
        undone.append("chunked")
    for coding in reversed([c.strip().lower() for c in (header(http, "content-encoding") or "").split(",")]):
        if coding in ("", "identity") or not payload:
            continue
        found = expanded(payload, coding)
        if found is None:
            return None, undone
        payload = found
        undone.append(coding)
    return payload, undone


def media_type(payload: bytes, http: list[tuple[str, str]]) -> str:
    said = (header(http, "content-type") or "").partition(";")[0].strip().lower()
    return said or ("text/html" if payload.lstrip()[:1] in (b"<", b"") else "text/plain")


def _meta_charset(payload: bytes) -> str | None:
    at, meta = 0, re.compile(rb"<meta[\s/]", re.I)
    while found := meta.search(payload, at):
        end = payload.find(b">", found.end())
        if end < 0:
            return None
        if said := META_CHARSET.search(payload, found.end(), end):
            return said[1].decode("ascii")
        at = end + 1
    return None


def decoded(payload: bytes, http: list[tuple[str, str]], page: bool = True) -> tuple[str, str, str]:
    """(text, charset, where it was found)."""
    found = HEADER_CHARSET.search(header(http, "content-type") or "")
    said, where = (found[1], "header") if found else (_meta_charset(payload) if page else None, "meta")
    try:
        return payload.decode(said or "utf-8", "replace"), (said or "utf-8").lower(), where if said else "default"
    except LookupError:  # a charset that does not exist
        return payload.decode("utf-8", "replace"), "utf-8", "default"


class Page:
    """What one pass over a page finds: text, title, language, links."""

    def __init__(self, page: str):
        self.page, self.title, self.language, self.links = page, None, None, 0
        self.pieces: list[str] = []
        self.in_head = False
        self.gone: set[str] = set()  # ends that the rest of the page does not hold
        at = 0
        while (tag := page.find("<", at)) >= 0:
            self._text(page[at:tag])
            at = self._tag(tag)
        self._text(page[at:])

    def _text(self, text: str) -> None:
        if self.in_head and text.strip():
            self.in_head = False  # content: the head had no end tag
        if text and not self.in_head:
            self.pieces.append(html.unescape(text))

    def _after(self, what: str, at: int, ignore_case: bool = False) -> int:
        """The place after the next ``what``, or the page's end."""
        if what in self.gone:
            return len(self.page)
        if ignore_case:
            found = re.compile(re.escape(what), re.I).search(self.page, at)
            end = found.end() if found else -1
        else:
            end = self.page.find(what, at)
            end = end + len(what) if end >= 0 else -1
        if end < 0:
            self.gone.add(what)
            return len(self.page)
        return end

    def _tag_end(self, at: int) -> int:
        """The place after the ``>`` of a tag whose attributes begin at ``at``;
        one in a quoted value does not count."""
        while found := TAG_END.search(self.page, at):
            if found[0] == ">":
                return found.end()
            quote = found[1]
            if quote in self.gone:
                at = found.end()
                continue
            end = self.page.find(quote, found.end())
            if end < 0:  # an open quote is an ordinary character
                self.gone.add(quote)
                end = found.end() - 1
            at = end + 1
        return len(self.page)

    def _tag(self, at: int) -> int:
        """Take the tag at ``at``; the place after it and what it hides."""
        page = self.page
        following = page[at + 1:at + 2]
        if page.startswith("<!--", at):
            return self._after("-->", at + 4)
        if following in ("!", "?"):
            return self._after(">", at + 2)
        closing = following == "/"
        named = TAG_NAME.match(page, at + 1 + closing)
        if not named:
            if closing:  # not a tag, but no text either
                return self._after(">", at + 2)
            self._text("<")
            return at + 1
        name = named[0].lower()
        end = self._tag_end(named.end())
        if end == len(page) and not page.endswith(">"):
            return end  # a tag that never ends
        if name == "head" and not closing:
            self.in_head = True
            return end
        if name == "head":
            self.in_head = False
            return end
        if self.in_head and name not in HEAD_ELEMENTS:
            self.in_head = False
        if not closing:
            attributes = page[named.end():end]
            if name == "a" and HREF.search(attributes):
                self.links += 1
            elif name == "html" and self.language is None and (said := LANGUAGE.search(attributes)):
                self.language = said[1].lower()
            if name in SKIPPED and not attributes.endswith("/>"):
                return self._tag_end(self._after(f"</{name}", end, True))
            if name == "title":
                close = self._after("</title", end, True)
                inside = page[end:close - len("</title")] if "</title" not in self.gone else page[end:]
                if self.title is None:
                    self.title = html.unescape(inside)
                elif not self.in_head:
                    self.pieces.append("\n" + html.unescape(inside) + "\n")
                return self._tag_end(close)
        if name in BLOCKS and not self.in_head:
            self.pieces.append("\n")
        return end

    def text(self) -> str:
        whole = "".join(self.pieces)
        if self.title is not None:
            whole = self.title.replace("\n", " ") + "\n" + whole
        return clean_lines(whole)


def clean_lines(text: str) -> str:
    lines = (SPACE.sub(" ", line).strip() for line in text.split("\n"))
    return "\n".join(x for x in lines if x)


def plain_text(page: str) -> str:
    return Page(page).text()


def derive(record: bytes | None) -> list[tuple]:
    """The rows (without page_id) of one response's derived records."""
    parsed = parse(record)
    if parsed is None:
        return []
    warc, status, http, payload = parsed
    source = warc.get("warc-record-id", "")
    uri, date = warc.get("warc-target-uri", ""), warc.get("warc-date", "")
    body, undone = content(payload, http)
    kind = media_type(body or b"", http)
    is_page = kind in PAGE_TYPES
    is_text = body is not None and (is_page or kind.startswith("text/") or kind in TEXT_TYPES)
    said = warc.get("warc-payload-digest")
    # sha1 is what this builder can hold the payload against
    ok = None
    if said and said.startswith("sha1:"):
        ok = said == digest(payload) or ("chunked" in undone and said == digest(dechunked(payload)))
    fields = [("status", status), ("media-type", kind), *(("undone", c) for c in undone)]
    if body is None:
        fields.append(("not-undone", header(http, "content-encoding") or ""))
    text = None
    if is_text:
        text, charset, where = decoded(body, http, is_page)
        fields += [("charset", charset), ("charset-from", where)]
    fields += [("payload-length", str(len(payload))), ("payload-digest", said or digest(payload))]
    if is_text and is_page:
        page = Page(text)
        text = page.text()
        fields.append(("outlinks", str(page.links)))
        if page.language:
            fields.append(("language", page.language))
        if page.title is not None:
            fields.append(("title", " ".join(page.title.split())))
    elif is_text:
        text = text.replace("\r\n", "\n")
    fields += [("http-header", f"{k}: {v}") for k, v in http]
    blocks = [("metadata", "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields))]
    if text is not None:
        blocks.append(("conversion", "text/plain; charset=utf-8", text))
    out = []
    for kind, content_type, text in blocks:
        block = text.encode("utf-8", "replace")
        own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} of {source}')}>"
        headers = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Refers-To", source), ("WARC-Target-URI", uri),
                   ("WARC-Date", date), ("WARC-Block-Digest", digest(block)), ("Content-Type", content_type)]
        headers += [(f"WARC-Source-{k}", warc[f"warc-{k.lower()}"]) for k in ("Block-Digest", "Payload-Digest") if warc.get(f"warc-{k.lower()}")]
        out.append((own, kind, source, uri, digest(block), len(block), ok, block.decode("utf-8"), serialise(headers, block)))
    return out


def derivatives(responses: DataFrame) -> DataFrame:
    """Rows of SCHEMA: one or two for each response record in ``responses``
    (page_id, record binary). ``record`` holds the whole WARC record, so that
    concatenated values are a WARC file."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        types = [pa.int64(), *[pa.string()] * 5, pa.int64(), pa.bool_(), pa.string(), pa.binary()]
        for batch in batches:
            rows = [(i, *row) for i, record in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                    for row in derive(record)]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    small_batches(responses.sparkSession)
    return responses.select(F.col("page_id").cast("long").alias("page_id"), "record").mapInArrow(work, SCHEMA)


def response_records(pages: DataFrame, date: str = "2024-01-15T00:00:00Z") -> DataFrame:
    """page_id and the response record of each row of ``pages`` (page_id, url,
    html): the input form of ``derivatives``. A null page has no payload, a
    null url an empty target."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for url, page in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                payload = (page or "").encode("utf-8", "replace")
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
                own = uuid.uuid5(uuid.NAMESPACE_URL, f"response {url} {hashlib.sha1(payload).hexdigest()}")
                out.append(serialise([
                    ("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:uuid:{own}>"), ("WARC-Target-URI", url or ""),
                    ("WARC-Date", date), ("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(http + payload)),
                    ("Content-Type", "application/http; msgtype=response")], http + payload))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["page_id", "record"])

    small_batches(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        work, "page_id long, record binary")
