"""Derivatives of WARC responses: linked metadata and plain text.

Each response gives a ``metadata`` record (JSON: title, description, language,
links, headers of the response) and a ``conversion`` record (the page's text).
Both name the response in WARC-Refers-To, and carry its target, date, payload
digest and HTTP headers, so either can be read without the source. Record ids
come from the response's id, digests are SHA-1 in base 32: a run that is
repeated makes the same bytes.

Cases: null or empty body: both records, with an empty text. Null url: the
target is left out of the headers. A body that is no HTTP message: read as HTML
as it is. Repeated rows: their records have equal ids. Broken bytes are read as
replacement characters, and the digest is that of the bytes. Broken records of a
file are passed over and told (``parse``). Markup that is never closed stays text; pages
are read in one pass, however many tags or comments they leave open.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VERSION = b"WARC/1.1"
DATE = "1970-01-01T00:00:00Z"  # of responses whose date nobody knows
HEADER_BYTES = 1 << 20  # in which a record's header must end
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space of URLs

RECORD = "record_id string, warc_type string, target_uri string, date string, refers_to string, content_type string, payload_digest string, block_digest string, content_length bigint, headers map<string,string>, block binary"
_NAMES = [part.split()[0] for part in RECORD.split(", ")]
_ARROW = [pa.string()] * 8 + [pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()]

# Openers of what a page does not show; each goes up to its own end mark.
_HIDDEN = re.compile(r"(?i)<!--|<(script|style|noscript|template|head)\b")
_ENDS = {name: re.compile(rf"(?i)</{name}\s*>") for name in ("script", "style", "noscript", "template", "head", "title")} | {"!--": re.compile("-->")}
_BREAKS = re.compile(r"(?i)</?(?:p|div|br|li|ul|ol|tr|table|h[1-6]|article|section|header|footer|nav|pre|blockquote|title|td|th)\b[^>]*>")
_TAG = re.compile(r"(?s)<[^>]*>")
_BLANKS = re.compile(r"[ \t\r\f\v\xa0]+")
_LINES = re.compile(r" ?\n[ \n]*")
_OPEN = re.compile(r"(?is)<(a|link|img|script|iframe|html|meta|title)\b([^>]*)>")
_LANG = re.compile(r"(?i)\blang\s*=\s*[\"']?([\w-]+)")
_ABOUT = re.compile(r"(?i)\bname\s*=\s*[\"']description[\"']")
_CONTENT = re.compile(r"(?i)\bcontent\s*=\s*(?=[\"'])")
_TARGET = re.compile(r"(?i)\b(href|src)\s*=\s*(?=[^\s>])")
_QUOTED = re.compile(r"(?s)\"([^\"]*)\"|'([^']*)'")
_BARE = re.compile(r"[^\s>]+")


def _without(page: str, openers: re.Pattern) -> str:
    """The page with a blank for everything from an opener to its end mark, read once from left to right.

    An opener whose mark does not follow stays; that none follows is remembered.
    """
    kept, at, endless = [], 0, set()
    while found := openers.search(page, at):
        name = (found[1] or "!--").lower() if found.re.groups else "!--"
        end = None if name in endless else _ENDS[name].search(page, found.end())
        if end is None:
            endless.add(name)
            kept.append(page[at : found.end()])
            at = found.end()
        else:
            kept += [page[at : found.start()], " "]
            at = end.end()
    return "".join([*kept, page[at:]])


def _in_tags(pattern: re.Pattern, by: str, page: str) -> str:
    """``pattern``, which runs up to a ">", replaced; it is not tried behind the last one, where each try would read to the end."""
    last = page.rfind(">") + 1
    return pattern.sub(by, page[:last]) + page[last:]


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(10).join(parts))}>"


def split_http(block: bytes) -> tuple[str, dict[str, str], bytes]:
    """Status line, headers in lower case, and body of an HTTP response."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or not mark:
        return "", {}, block
    lines = head.decode("latin-1").split("\r\n")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if colon:
            key = name.strip().lower()
            headers[key] = f"{headers[key]}, {value.strip()}" if key in headers else value.strip()
    return lines[0], headers, body


def page_text(page: str) -> str:
    """The visible text, one line per block element."""
    text = _in_tags(_BREAKS, "\n", _without(page, _HIDDEN))
    text = html.unescape(_in_tags(_TAG, "", text))
    return _LINES.sub("\n", _BLANKS.sub(" ", text)).strip()


def _value(page: str, at: int) -> str:
    """An attribute's value: within quotes, or up to a blank."""
    quoted = _QUOTED.match(page, at)
    if quoted:
        return quoted[1] if quoted[1] is not None else quoted[2]
    return _BARE.match(page, at)[0]


def page_metadata(page: str, url: str | None) -> dict:
    """Title, description, language and links (in order, absolute if the url is known); one pass over the tags."""
    clean = lambda m: html.unescape(_BLANKS.sub(" ", m).strip())
    seen = _without(page, re.compile("<!--"))
    made: dict = {"title": None, "description": None, "language": None, "links": []}
    titled, at, last = False, 0, seen.rfind(">") + 1
    while tag := _OPEN.search(seen, at, last):
        at, kind, inside = tag.end(), tag[1].lower(), tag.span(2)
        if kind == "title":
            if not titled and (end := _ENDS["title"].search(seen, at)):
                made["title"], at = clean(seen[at : end.start()]), end.end()
            titled = True  # if the first has no end, none has
        elif kind == "html":
            if made["language"] is None and (lang := _LANG.search(seen, *inside)):
                made["language"] = lang[1].lower()
        elif kind == "meta":
            if made["description"] is None and (about := _ABOUT.search(seen, *inside)):
                if content := _CONTENT.search(seen, about.end(), inside[1]):
                    made["description"] = clean(_value(seen, content.end()))
        elif target := _TARGET.search(seen, *inside):
            link = html.unescape(_value(seen, target.end())).strip()
            try:
                link = urljoin(url or "", link)
            except ValueError:
                pass
            made["links"].append({"path": f"{tag[1].upper()}@/{target[1].lower()}", "url": link})
    return made


def response(url: str | None, body: bytes, date: str = DATE, content_type: str = "text/html; charset=utf-8") -> tuple:
    """A response record around a page's body."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: {content_type}\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    own, block = record_id("response", url or "", date, digest(body)), head + body
    extra = {"WARC-Identified-Payload-Type": content_type.split(";")[0]}
    return (own, "response", url, date, None, "application/http; msgtype=response", digest(body), digest(block), len(block), extra, block)


def derive(source: str, url: str | None, date: str, block: bytes | None, payload_digest: str | None = None) -> list[tuple]:
    """The metadata and the conversion record of one response."""
    status, http, body = split_http(block or b"")
    charset = re.search(r"charset=[\"']?([\w-]+)", http.get("content-type", ""))
    try:
        page = body.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        page = body.decode("utf-8", "replace")
    payload = payload_digest or digest(body)
    about = {"envelope": {"refers_to": source, "target_uri": url, "date": date, "payload_digest": payload, "status": status, "headers": http}}
    made = []
    for kind, content_type, data in (
        ("metadata", "application/json", json.dumps(about | page_metadata(page, url), ensure_ascii=False).encode()),
        ("conversion", "text/plain; charset=utf-8", page_text(page).encode()),
    ):
        extra = {"X-Source-Payload-Digest": payload, "X-Source-Status": status} | {f"X-Source-{k.title()}": v for k, v in http.items()}
        made.append((record_id(kind, source), kind, url, date, source, content_type, digest(data), digest(data), len(data), extra, data))
    return made


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_NAMES)
    columns = [[list(m.items()) for m in c] if n == "headers" else c for n, c in zip(_NAMES, columns)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ARROW)], _NAMES)


def responses(pages: DataFrame, url: str = "url", body: str = "html") -> DataFrame:
    """Response records of crawled pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                pairs = zip(part.column("url").to_pylist(), part.column("body").to_pylist())
                yield _rows([response(u, (b or "").encode()) for u, b in pairs])

    return pages.select(F.col(url).cast("string").alias("url"), F.col(body).cast("string").alias("body")).mapInArrow(run, RECORD)


def derivatives(records: DataFrame) -> DataFrame:
    """Two records for every response among ``records``; other types are passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                columns = [c.to_pylist() for c in batch.slice(start, 500).columns]
                yield _rows([r for source, u, d, b, p in zip(*columns) for r in derive(source, u, d or DATE, b, p)])

    read = records.filter("warc_type = 'response'").select("record_id", "target_uri", "date", "block", "payload_digest")
    return read.mapInArrow(run, RECORD)


def serialize(row: dict) -> bytes:
    """One record in the file format."""
    fields = [
        ("WARC-Type", row["warc_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["date"]),
        ("WARC-Target-URI", row["target_uri"]), ("WARC-Refers-To", row["refers_to"]), ("WARC-Payload-Digest", row["payload_digest"]),
        ("WARC-Block-Digest", row["block_digest"]), ("Content-Type", row["content_type"]), ("Content-Length", str(row["content_length"])),
        *dict(row["headers"] or {}).items(),
    ]
    lines = [f"{k}: {re.sub(r'[\r\n]+', ' ', v)}".encode() for k, v in fields if v is not None]
    return VERSION + b"\r\n" + b"\r\n".join(lines) + b"\r\n\r\n" + (row["block"] or b"") + b"\r\n\r\n"


def inflate(content: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of a file in parts, gzip members one after another; what is cut off or no gzip ends them."""
    if content[:2] != b"\x1f\x8b":
        for at in range(0, len(content), step):
            yield content[at : at + step]
        return
    member, left, at = zlib.decompressobj(31), b"", 0
    while left or at < len(content):
        if not left:
            left, at = content[at : at + step], at + step
        try:
            yield member.decompress(left, step)
        except zlib.error:
            return
        left = member.unconsumed_tail
        if member.eof:
            left, member = member.unused_data, zlib.decompressobj(31)


BROKEN = "broken"


def parse(data: bytes | Iterator[bytes]) -> Iterator[tuple]:
    """The records of an uncompressed file, given whole or in parts; one record is held at a time.

    A record without an end to its header, with a length that is no number, or
    shorter than its length says gives a record of type ``broken`` with the reason in its headers
    and no block; reading goes on at the next line that begins a record.
    """
    parts = iter([data] if isinstance(data, bytes) else data)
    buffer, ended = bytearray(), False

    def more() -> bool:
        nonlocal ended
        part = next(parts, None)
        ended = part is None
        if part:
            buffer.extend(part)
        return not ended

    def broken(reason: str) -> tuple:
        return (None, BROKEN, None, None, None, None, None, None, 0, {"reason": reason}, None)

    def skip() -> None:
        """To the next beginning of a record."""
        del buffer[:1]
        while True:
            at = buffer.find(b"\nWARC/1.")
            if at >= 0:
                del buffer[: at + 1]
                return
            del buffer[: max(0, len(buffer) - 8)]
            if not more():
                buffer.clear()
                return

    while True:
        while len(buffer) < 7 and more():
            pass
        while buffer[:2] == b"\r\n":
            del buffer[:2]
            while len(buffer) < 7 and more():
                pass
        if not buffer:
            return
        if not buffer.startswith(b"WARC/1."):
            yield broken("no record begins here")
            skip()
            continue
        end, tried = buffer.find(b"\r\n\r\n"), 0
        while end < 0 and len(buffer) <= HEADER_BYTES and more():
            end, tried = buffer.find(b"\r\n\r\n", max(0, tried - 3)), len(buffer)
        if end < 0:
            yield broken("the header has no end")
            skip()
            continue
        fields: dict[str, str] = {}
        for line in bytes(buffer[:end]).split(b"\r\n")[1:]:
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip()] = value.strip()
        length = fields.pop("Content-Length", "0")
        if not (length.isascii() and length.isdigit()):
            yield broken("the length is no number")
            skip()
            continue
        size = int(length)
        while len(buffer) < end + 4 + size and more():
            pass
        if len(buffer) < end + 4 + size:
            yield broken("the block is cut off")
            skip()
            continue
        block = bytes(buffer[end + 4 : end + 4 + size])
        take = lambda name: fields.pop(name, None)
        own = [take(f"WARC-{n}") for n in ("Record-ID", "Type", "Target-URI", "Date", "Refers-To")]
        own += [take("Content-Type"), take("WARC-Payload-Digest"), take("WARC-Block-Digest"), size]
        del buffer[: end + 4 + size]
        yield (*own, fields, block)


def as_files(records: DataFrame) -> DataFrame:
    """(name, content): a gzip file per partition, one member per record, as rows to be stored by the caller."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for k, batch in enumerate(batches):
            members = b"".join(gzip.compress(serialize(row), mtime=0) for row in batch.to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([f"part-{part:05d}-{k:05d}.warc.gz"]), pa.array([members])], ["name", "content"])

    return records.select(_NAMES).mapInArrow(run, "name string, content binary")


def read_files(spark, path: str) -> DataFrame:
    """The records of all .warc and .warc.gz files below ``path``, by Spark's own reader; broken ones as ``parse`` gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content").to_pylist():
                rows = []
                for record in parse(inflate(content)):
                    rows.append(record)
                    if len(rows) == 500:
                        yield _rows(rows)
                        rows = []
                yield _rows(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.warc*").load(path)
    return files.select("content").mapInArrow(run, RECORD)
