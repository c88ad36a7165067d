"""WARC derivatives: metadata and plain-text conversion records linked to the responses they come from.

Every response gives a ``metadata`` record (application/warc-fields: the source's HTTP headers, payload digest, title, language, links)
and a ``conversion`` record (its text).  Both refer to the response by WARC-Refers-To with its target URI and date, and carry their own
block digests; record ids follow from the response id, so a rerun gives the same records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, shared_folder

DATE = "2024-01-01T00:00:00Z"
RECORD = "page_id long, kind string, record_id string, refers_to string, target_uri string, source_digest string, block_digest string, record binary"
FILE_BYTES = 32 << 20
READ_BYTES = 4 << 20                        # records given on at once, about
LEVEL = 6                                   # of compression
LISTED = 100_000                            # files whose names are broadcast; more are joined by a shuffle

_DROP = re.compile(r"<!--.*?(?:-->|$)|<(script|style|template|noscript)\b.*?(?:</\1\s*>|$)", re.S | re.I)
_BREAK = frozenset("address article aside blockquote br div dd dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 head header hr li main nav ol p pre section table td th tr ul title".split())
_OPEN = re.compile(r"</?(?=[a-zA-Z!])([a-zA-Z0-9]*)")
_TITLE, _TITLE_END = re.compile(r"<title\b", re.I), re.compile(r"</title\s*>", re.I)
_HTML, _LANG = re.compile(r"<html\b", re.I), re.compile(r"\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
_ANCHOR, _HREF = re.compile(r"<a\b", re.I), re.compile(r"\bhref\s*=", re.I)
_VALUE = re.compile(r"\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")


def digest(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def _tag_ends(page: str) -> tuple[list[int], list[int]]:
    """(positions of > and quotes, end of a tag whose rest begins there or -1), from the last to the first: linear in the page."""
    at = [m.start() for m in re.finditer("[>\"']", page)]
    ends, closing = [-1] * len(at), {}
    for k in range(len(at) - 1, -1, -1):
        mark = page[at[k]]
        if mark == ">":
            ends[k] = at[k]
        else:
            partner = closing.get(mark)
            ends[k] = ends[partner + 1] if partner is not None and partner + 1 < len(at) else -1
            closing[mark] = k
    return at, ends


def without_tags(page: str) -> str:
    """The page without its tags, those of blocks as line ends; > inside a quoted value ends no tag, and < that opens none is text."""
    at, ends = _tag_ends(page)
    out, done, k = [], 0, 0
    for m in _OPEN.finditer(page):
        if m.start() < done:
            continue
        while k < len(at) and at[k] < m.end():
            k += 1
        end = ends[k] if k < len(at) else -1
        if end < 0:
            continue
        out.append(page[done:m.start()])
        out.append("\n" if m[1].lower() in _BREAK else "")
        done = end + 1
    out.append(page[done:])
    return "".join(out)


def _regions(start: re.Pattern, page: str):
    """(from, to) of what follows each start up to the next >; a start inside such a region is skipped, so they do not overlap."""
    done = 0
    for m in start.finditer(page):
        if m.start() >= done:
            end = page.find(">", m.end())
            done = len(page) if end < 0 else end
            yield m.end(), done


def title_of(page: str) -> str | None:
    for _, end in _regions(_TITLE, page):
        close = _TITLE_END.search(page, end + 1) if end < len(page) else None
        return html.unescape(page[end + 1:close.start()]) if close else None
    return None


def language_of(page: str) -> str | None:
    for lo, hi in _regions(_HTML, page):
        m = _LANG.search(page, lo, hi)
        if m:
            return m[1].lower()
    return None


def links_of(page: str) -> list[str]:
    """href of every anchor, in order."""
    out = []
    for lo, hi in _regions(_ANCHOR, page):
        for m in _HREF.finditer(page, lo, hi):
            value = _VALUE.match(page, m.end())
            if value:
                out.append(html.unescape(value[1] or value[2] or value[3] or ""))
                break
    return out


def plain_text(page: str) -> str:
    """Text of a page: a line per block, entities resolved, white space collapsed; script, style and comments left out."""
    lines = html.unescape(without_tags(_DROP.sub("", page))).split("\n")
    return "\n".join(x for x in (" ".join(line.split()) for line in lines) if x)


def serialize(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return b"WARC/1.1\r\n" + head.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(header_fields(lines))
    return fields, rest[:int(fields["Content-Length"])]


def header_fields(lines: list[str]) -> list[tuple[str, str]]:
    """(name, value) of header lines: white space around a value is no part of it, a folded line continues the last value, lines without a colon are none."""
    out: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], (out[-1][1] + " " + line.strip()).strip())
        elif ":" in line:
            name, _, value = line.partition(":")
            out.append((name.strip(), value.strip()))
    return out


def _one_line(s: str) -> str:
    return " ".join(s.split())


def response(page_id, url, page, date: str = DATE) -> tuple[list[tuple[str, str]], bytes]:
    """Headers and HTTP block of the response record of a page."""
    payload = (page or "").encode("utf-8", "surrogatepass")
    target = _one_line(url or "") or f"urn:page:{page_id}"
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode() + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}|{target}|{digest(payload)}")
    return [("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Target-URI", target), ("WARC-Date", date),
            ("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(block)), ("Content-Type", "application/http;msgtype=response")], block


def derive(headers: dict[str, str], block: bytes) -> list[tuple[str, str, str, bytes]]:
    """(kind, record id, block digest, record) of the metadata and the conversion of a response."""
    http, _, payload = block.partition(b"\r\n\r\n")
    page = payload.decode("utf-8", "replace")
    source, target, date = headers["WARC-Record-ID"], headers["WARC-Target-URI"], headers["WARC-Date"]
    title, lang = title_of(page), language_of(page)
    status, *lines = http.decode("utf-8", "replace").split("\r\n")
    fields = [("source-" + k, _one_line(v)) for k, v in header_fields(lines)]
    fields += [("source-status", _one_line(status)), ("source-payload-digest", headers.get("WARC-Payload-Digest") or digest(payload))]
    fields += [("title", _one_line(title))] if title is not None else []
    fields += [("language", lang)] if lang else []
    fields += [("outlink", _one_line(x)) for x in links_of(_DROP.sub("", page))]
    blocks = {"metadata": ("application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "surrogatepass")),
              "conversion": ("text/plain; charset=utf-8", plain_text(page).encode("utf-8", "surrogatepass"))}
    out = []
    for kind, (media, body) in blocks.items():
        name = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, source + kind)}>"
        head = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Target-URI", target), ("WARC-Date", date), ("WARC-Refers-To", source),
                ("WARC-Refers-To-Target-URI", target), ("WARC-Refers-To-Date", date), ("WARC-Block-Digest", digest(body)), ("Content-Type", media)]
        out.append((kind, name, digest(body), serialize(head, body)))
    return out


def _build(date: str):
    def run(batches):
        for batch in batches:
            rows = []
            for page_id, url, page in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                headers, block = response(page_id, url, page, date)
                h = dict(headers)
                for kind, name, mark, record in derive(h, block):
                    rows.append((page_id, kind, name, h["WARC-Record-ID"], h["WARC-Target-URI"], h["WARC-Payload-Digest"], mark, record))
            names = [x.split(" ")[0] for x in RECORD.split(", ")]
            kinds = [pa.int64()] + [pa.string()] * 6 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
    return run


def build_derivatives(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Two records for every row of ``pages`` (page_id, url, html): metadata, then conversion; ``record`` holds the WARC bytes.

    Null or empty html is an empty payload; a null or empty url becomes ``urn:page:<page_id>``.  Equal rows give equal records,
    each of them kept.  Very long pages are one record.  Other columns are ignored.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_build(date), RECORD)


PAGE_ID = "X-Page-ID"                       # extension field of the responses made here: the row they come from


def _responses(date: str):
    def run(batches):
        for batch in batches:
            out = []
            for page_id, url, page in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                headers, block = response(page_id, url, page, date)
                out.append(serialize(headers + ([] if page_id is None else [(PAGE_ID, str(page_id))]), block))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
    return run


def response_records(pages: DataFrame, date: str = DATE) -> DataFrame:
    """(record): one WARC response for every row of ``pages``, as ``build_derivatives`` takes the rows."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_responses(date), "record binary")


def _derive_records(batches):
    for batch in batches:
        rows = []
        for raw in batch.column("record"):
            h, block = parse(raw.as_py())
            if h.get("WARC-Type") != "response":
                continue
            for kind, name, mark, record in derive(h, block):
                rows.append((int(h[PAGE_ID]) if PAGE_ID in h else None, kind, name, h["WARC-Record-ID"], h["WARC-Target-URI"],
                             h.get("WARC-Payload-Digest"), mark, record))
        names = [x.split(" ")[0] for x in RECORD.split(", ")]
        kinds = [pa.int64()] + [pa.string()] * 6 + [pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def derive_records(records: DataFrame) -> DataFrame:
    """The two derivatives of every response among WARC records (record), as in ``build_derivatives``; records of
    other types give none.  page_id is null where the response does not name one.  Every header of the response is kept, empty ones
    and ones without a space after the colon included."""
    return records.select("record").mapInArrow(_derive_records, RECORD)


def _write(folder: str):
    def run(batches):
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(folder)
        held, size = [], 0

        def close():
            name = f"{uuid.uuid4().hex}.warc.gz"
            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(b"".join(held))
            return pa.RecordBatch.from_pydict({"name": [name], "records": [len(held)], "bytes": [size]})

        for batch in batches:
            for raw in batch.column("record"):
                held.append(gzip.compress(raw.as_py(), LEVEL, mtime=0))   # one gzip member a record
                size += len(held[-1])
                if size >= FILE_BYTES:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()
    return run


def write_warc(records: DataFrame, folder: str) -> DataFrame:
    """Write the records to .warc.gz files in a folder that all executors reach; returns the files (name, records, bytes) of the finished tasks."""
    folder = shared_folder(records.sparkSession, folder)
    return durable(records.select("record").mapInArrow(_write(folder), "name string, records long, bytes long"))


def _members(batches):
    import zlib
    for batch in batches:
        for raw in batch.column("content"):
            view, at, out, size = memoryview(raw.as_buffer()), 0, [], 0
            while at < len(view):
                d, piece = zlib.decompressobj(31), []
                while at < len(view) and not d.eof:                 # the input goes in by pieces: what follows a member is not copied whole
                    part = view[at:at + (64 << 10)]
                    piece.append(d.decompress(part))
                    at += len(part) - len(d.unused_data)
                out.append(b"".join(piece) + d.flush())
                size += len(out[-1])
                if size >= READ_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])


def read_warc(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """Records of the listed files."""
    stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    names = files.select("name")
    names = F.broadcast(names) if names.count() <= LISTED else names
    return (stored.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content").join(names, "name")
            .mapInArrow(_members, "record binary"))
