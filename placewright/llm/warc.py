"""WARC derivatives (operator 7).

``parse`` reads WARC records (plain or gzip members) from bytes, one after another, and holds one record and a window
of the file; ``derive`` turns a response record into a metadata
record (JSON: source headers, HTTP status and headers, title, links) and a plain-text conversion record.  Both refer
to the response by ``WARC-Refers-To``, keep its target URI, date and payload digest, carry a block digest of their
own, and name each other by ``WARC-Concurrent-To``.  Identifiers are UUIDs drawn from the source identifier, so
reruns agree.  Bodies are read by their transfer and content encodings, and decoded by the charset of the HTTP head, a
byte order mark or the page's own declaration.

Defined results: null or empty bytes have no records; a response without an HTTP head counts as all payload; bytes
that can't be decoded become U+FFFD; repeated responses give repeated records; very long payloads are converted
whole, and so are very long headers.  A header that the next record begins in is skipped.  A truncated last record
is read as far as it goes; so is one in a damaged gzip member, after which the next member is read.  A body that isn't
what its encoding says stays as it is.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placewright.llm.common import map_arrow, read

_SPACE = uuid.UUID("6f3c3f0e-5f7b-4d0b-9a55-2f9b6c1de001")
Headers = list[tuple[str, str]]


def digest(data: bytes) -> str:
    """A labelled SHA-1 digest in base 32, as WARC headers have it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(headers: Headers, block: bytes) -> bytes:
    """One serialised record."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.0\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def response(target: str, date: str, payload: bytes, content_type: str = "text/html; charset=utf-8", key: str = "") -> bytes:
    """A response record for a payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: {content_type}\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    name = f"<urn:uuid:{uuid.uuid5(_SPACE, f'{key} {target} {date}')}>"
    return record([("WARC-Type", "response"), ("WARC-Record-ID", name), ("WARC-Date", date), ("WARC-Target-URI", target), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(block))], block)


#: Bytes of a file that are unpacked or read at a time.
WINDOW = 1 << 14


class _Input:
    """A file's bytes, unpacked; ``run`` ends at the end or where a gzip member is damaged, then goes on behind it."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0
        self.packed = data[:2] == b"\x1f\x8b"

    def run(self) -> Iterator[bytes]:
        view = memoryview(self.data)
        if not self.packed:
            for self.at in range(WINDOW, len(self.data) + WINDOW, WINDOW):
                yield bytes(view[self.at - WINDOW : self.at])
            return
        while self.at < len(self.data):
            member, begin = zlib.decompressobj(31), self.at
            try:
                while not member.eof and self.at < len(self.data):
                    window = view[self.at : self.at + WINDOW]
                    made = member.decompress(window)
                    self.at += len(window) - len(member.unused_data)
                    yield made
            except zlib.error:
                found = self.data.find(b"\x1f\x8b\x08", begin + 1)
                self.at = found if found >= 0 else len(self.data)
                return


def _head(data: bytes) -> tuple[str, Headers, int]:
    """First line, headers and the length of both, of a block of header lines."""
    stop = data.find(b"\r\n\r\n")
    size = stop + 4
    if stop < 0:
        stop, size = data.find(b"\n\n"), data.find(b"\n\n") + 2
    if stop < 0:
        return "", [], 0
    lines = data[:stop].decode("utf-8", "replace").replace("\r\n", "\n").split("\n")
    found: Headers = []
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and found:
            found[-1] = found[-1][0], f"{found[-1][1]} {line.strip()}"
        elif ":" in line:
            name, value = line.split(":", 1)
            found.append((name.strip(), value.strip()))
    return lines[0], found, size


def value_of(headers: Headers, name: str, default: str = "") -> str:
    return next((v for k, v in headers if k.lower() == name.lower()), default)


_NEXT = re.compile(rb"\nWARC/\d+\.\d+\r?\n")


def _head_end(data: bytes | bytearray, start: int = 0) -> int:
    """Where the header that ``data`` begins with ends: at a blank line, ended as its first line is; -1 without an end."""
    line = data.find(b"\n")
    ends = (b"\r\n\r\n", b"\n\n") if data[line - 1 : line] == b"\r" else (b"\n\n", b"\r\n\r\n")
    return next((k + len(e) for e in ends if (k := data.find(e, max(0, start - 3))) >= 0), -1)


def _records(source: Iterator[bytes]) -> Iterator[tuple[Headers, bytes]]:
    held = bytearray()

    def more() -> bool:
        chunk = next(source, None)
        held.extend(chunk or b"")
        return chunk is not None

    while True:
        at = held.find(b"WARC/")
        if at < 0:
            del held[:-4]
            if not more():
                return
            continue
        del held[:at]
        looked, end = 0, -1
        while (end := _head_end(held, looked)) < 0:
            looked = len(held)
            if not more():  # no blank line follows, so no later header is whole either
                return
        broken = _NEXT.search(held, 0, end)
        if broken:
            del held[: broken.start() + 1]
            continue
        _, headers, size = _head(bytes(held[:end]))
        n = value_of(headers, "Content-Length", "0")
        n = int(n) if n.isdigit() else 0
        while len(held) < size + n and more():
            pass
        block = bytes(held[size : size + n])
        del held[: size + n]
        yield headers, block


def parse(data: bytes | None) -> Iterator[tuple[Headers, bytes]]:
    """(headers, block) of each record."""
    whole = _Input(data or b"")
    while whole.at < len(whole.data):
        yield from _records(whole.run())


# -- bodies and pages -----------------------------------------------------------------------------------


def _unchunked(body: bytes) -> bytes:
    """A body without the lengths of its chunks; as it is, if it doesn't come in chunks."""
    out, at = [], 0
    while True:
        line = body.find(b"\n", at)
        length = body[at:line].split(b";")[0].strip() if line >= 0 else b""
        if not re.fullmatch(rb"[0-9a-fA-F]{1,15}", length):
            return b"".join(out) if out and at >= len(body) else body
        n = int(length, 16)
        if not n:
            return b"".join(out)
        out.append(body[line + 1 : line + 1 + n])
        at = line + 1 + n
        at += 2 if body[at : at + 2] == b"\r\n" else body[at : at + 1] == b"\n"


def _unpacked(body: bytes, kind: str) -> bytes:
    """A body without its content encoding, as far as it goes; as it is, if it isn't encoded so."""
    for bits in {"gzip": (31,), "x-gzip": (31,), "deflate": (15, -15)}.get(kind, ()):
        stream, out = zlib.decompressobj(bits), []
        try:
            for at in range(0, len(body), WINDOW):
                out.append(stream.decompress(body[at : at + WINDOW]))
        except zlib.error:
            pass
        if any(out):
            return b"".join(out)
    return body


def body_of(http: Headers, payload: bytes) -> bytes:
    """What a payload holds, by the encodings of its HTTP head; the last one named was applied last."""
    if "chunked" in value_of(http, "Transfer-Encoding").lower():
        payload = _unchunked(payload)
    for kind in reversed(value_of(http, "Content-Encoding").lower().split(",")):
        payload = _unpacked(payload, kind.strip())
    return payload


_CHARSET = re.compile(r"charset\s*=\s*[\"']?\s*([\w-]+)", re.I)
_META = re.compile(rb"<meta\b[^>]*?charset\s*=\s*[\"']?\s*([\w-]+)", re.I)
_MARKS = ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16"))


def page_of(http: Headers, body: bytes) -> str:
    """A body as text: by the HTTP head's charset, a byte order mark, or what its first 1024 bytes declare."""
    named = _CHARSET.search(value_of(http, "Content-Type"))
    declared = None if named else _META.search(body, 0, 1024)
    mark = next((c for m, c in _MARKS if body.startswith(m)), None)
    charset = named[1] if named else mark or (declared[1].decode() if declared else "utf-8")
    try:
        return body.decode(charset, "replace")
    except (LookupError, ValueError):  # unknown, or not a text encoding
        return body.decode("utf-8", "replace")


#: A comment, a tag with its attributes (quoted ones can hold ">"), or another thing in angle brackets.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|</?[a-zA-Z!?][^>]*>|<[!?][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_DROP = frozenset("script style noscript template".split())
_BREAK = frozenset("p div br li ul ol h1 h2 h3 h4 h5 h6 table tr td th section article header footer nav title head body html blockquote pre hr main aside form dl dt dd".split())
_LINKS = {"a": "href", "area": "href", "link": "href", "img": "src", "script": "src", "iframe": "src", "form": "action"}
_CLOSE = {name: re.compile(rf"</{name}\b[^>]*>|\Z", re.I) for name in (*_DROP, "title")}


def read_page(page: str) -> tuple[str, str, list[dict[str, str]]]:
    """(title, visible text, links in document order) in one pass; the text has a line for each block."""
    text, links_, title, at = [], [], None, 0
    stop = page.rfind(">") + 1  # nothing ends behind it; looking there would cost time for every "<"
    while (found := _TOKEN.search(page, at, stop)) is not None:
        text.append(page[at : found.start()])
        at = found.end()
        if at == stop and found[0].startswith("<!--") and not found[0].endswith("-->"):
            at = len(page)
        name = (found["name"] or "").lower()
        if not name:
            continue
        if name in _BREAK:
            text.append("\n")
        if found["end"]:
            continue
        if name in _LINKS:
            wanted = _LINKS[name]
            value = next((m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(found["rest"]) if m[1].lower() == wanted), None)
            if value is not None:
                links_.append({"path": f"{name.upper()}@/{wanted}", "url": html.unescape(value)})
        if name in _CLOSE:  # what is inside has no tags
            close = _CLOSE[name].search(page, at)
            if name == "title":
                inner = page[at : close.start()]
                title = " ".join(html.unescape(inner).split()) if title is None else title
                text += [inner, "\n"]
            else:
                text.append(" ")
            at = close.end()
    text.append(page[at:].split("<!--", 1)[0])
    lines = (" ".join(line.split()) for line in html.unescape("".join(text)).split("\n"))
    return title or "", "\n".join(line for line in lines if line), links_


def plain_text(page: str) -> str:
    """Visible text: one line per block, runs of blanks collapsed, entities decoded."""
    return read_page(page)[1]


def links(page: str) -> list[dict[str, str]]:
    """Links in document order."""
    return read_page(page)[2]


def _by_name(headers: Headers) -> dict[str, str | list[str]]:
    """Headers by name; of one that is repeated, the list of its values."""
    out: dict[str, str | list[str]] = {}
    for name, value in headers:
        had = out.get(name)
        out[name] = value if had is None else [*([had] if isinstance(had, str) else had), value]
    return out


def derive(headers: Headers, block: bytes) -> list[tuple[Headers, bytes]]:
    """The metadata and the conversion record of a response; nothing for other records."""
    if value_of(headers, "WARC-Type").lower() != "response":
        return []
    status, http, size = _head(block) if block[:5] == b"HTTP/" else ("", [], 0)
    payload = block[size:]
    source = value_of(headers, "WARC-Record-ID")
    title, text, found = read_page(page_of(http, body_of(http, payload)))
    own = {kind: f"<urn:uuid:{uuid.uuid5(_SPACE, f'{kind} {source}')}>" for kind in ("metadata", "conversion")}
    envelope = {
        "source": _by_name(headers),
        "http": {"status": status, "headers": _by_name(http)},
        "payload": {"length": len(payload), "digest": digest(payload), "declared-digest": value_of(headers, "WARC-Payload-Digest")},
        "html": {"title": title, "links": found},
    }
    made = []
    for kind, other, content, data in (
        ("metadata", "conversion", "application/json", json.dumps(envelope, ensure_ascii=False, separators=(",", ":")).encode()),
        ("conversion", "metadata", "text/plain; charset=utf-8", text.encode("utf-8", "replace")),
    ):
        head = [("WARC-Type", kind), ("WARC-Record-ID", own[kind]), ("WARC-Refers-To", source), ("WARC-Concurrent-To", own[other])]
        head += [(k, value_of(headers, k)) for k in ("WARC-Target-URI", "WARC-Date", "WARC-Payload-Digest") if value_of(headers, k)]
        made.append(([*head, ("Content-Type", content), ("WARC-Block-Digest", digest(data))], data))
    return made


RECORDS = "record_id string, type string, refers_to string, concurrent_to string, target_uri string, date string, payload_digest string, block_digest string, headers map<string,string>, header_list array<struct<name:string,value:string>>, block binary"
_NAMES = ["WARC-Record-ID", "WARC-Type", "WARC-Refers-To", "WARC-Concurrent-To", "WARC-Target-URI", "WARC-Date", "WARC-Payload-Digest", "WARC-Block-Digest"]
_COLUMNS = ["record_id", "type", "refers_to", "concurrent_to", "target_uri", "date", "payload_digest", "block_digest"]


def _table(rows: list[tuple[Headers, bytes]]) -> pa.Table:
    columns = [pa.array([value_of(h, n) or None for h, _ in rows], pa.string()) for n in _NAMES]
    heads = pa.array([list(dict(h[::-1]).items()) for h, _ in rows], pa.map_(pa.string(), pa.string()))
    every = pa.array([[{"name": k, "value": v} for k, v in h] for h, _ in rows], pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())])))
    return pa.table([*columns, heads, every, pa.array([b for _, b in rows], pa.binary())], names=[*_COLUMNS, "headers", "header_list", "block"])


def derivatives(files: DataFrame, bytes_col: str = "content") -> DataFrame:
    """All derived records of WARC bytes, such as the ``content`` of ``spark.read.format("binaryFile")``.

    Of a name that a record's header repeats, ``headers`` has the first value and ``header_list`` all.
    """

    def work(table: pa.Table):
        for data in table["b"]:
            rows, size = [], 0
            for headers, block in parse(data.as_py()):
                rows += derive(headers, block)
                size += len(block)
                if len(rows) >= 512 or size > 8 << 20:
                    yield _table(rows)
                    rows, size = [], 0
            yield _table(rows)

    return map_arrow(files.select(F.col(bytes_col).cast("binary").alias("b")), work, RECORDS)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a response record, parsed again and derived; digests of both derivatives."""

    def work(table: pa.Table) -> pa.Table:
        rows = []
        for i, url, page in zip(table["page_id"].to_pylist(), table["url"].to_pylist(), table["html"].to_pylist(), strict=True):
            date = "2024-01-01T00:00:00Z"
            data = response(url or "", date, (page or b""), key=str(i))
            ((headers, block),) = parse(data)
            (meta, envelope), (text, body) = derive(headers, block)
            found = json.loads(envelope)
            rows.append((i, value_of(headers, "WARC-Record-ID"), value_of(meta, "WARC-Record-ID"), value_of(text, "WARC-Record-ID"), value_of(text, "WARC-Refers-To"), value_of(text, "WARC-Payload-Digest"), value_of(text, "WARC-Block-Digest"), value_of(meta, "WARC-Block-Digest"), found["html"]["title"], len(found["html"]["links"]), len(body)))
        names = ["page_id", "response_id", "metadata_id", "conversion_id", "refers_to", "payload_digest", "text_digest", "metadata_digest", "title", "n_links", "text_bytes"]
        kinds = [pa.int64(), *[pa.string()] * 8, pa.int64(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    pages = read(spark, sf_dir, "pages", "page_id", "url", "html")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.col("html").cast("binary").alias("html"))
    return map_arrow(pages, work, "page_id long, response_id string, metadata_id string, conversion_id string, refers_to string, payload_digest string, text_digest string, metadata_digest string, title string, n_links long, text_bytes long")


QUERIES = {"op7_warc": op7_warc}
ORACLES: dict[str, str] = {}
