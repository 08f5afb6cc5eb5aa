"""Derived WARC records: metadata and plain text of captured responses.

Every response gives a metadata record and a conversion record. Both refer to the
response by its identifier, target and date; the metadata carries the response's
own headers and digests and names the conversion. Records are text and are written
by Spark's text writer, one record after the other as the format asks for.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..shipping import ship_package

VERSION = "WARC/1.1"
END = "\r\n\r\n"
TEXT_TYPE = "text/plain; charset=utf-8"
FIELDS_TYPE = "application/warc-fields"

_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9]*)|<[/!?a-zA-Z]")
_CLOSES = {
    n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "noscript", "template", "title")
}
# Elements whose content no reader sees.
_HIDDEN = frozenset(("script", "style", "noscript", "template"))
# Elements that begin a line.
_BREAK = frozenset(
    "address article aside blockquote body br dd div dl dt fieldset figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr html li main nav ol p pre section table td th title tr ul".split()
)
_LANG = re.compile(r"\blang\s*=\s*[\"']?([^\"'\s>]+)", re.I)
_HREF = re.compile(r"\bhref\s*=\s*", re.I)
_BARE = re.compile(r"[^\s>]+")
_RUN = re.compile(r"[^\S\n]+")


@dataclass
class Page:
    """What a page shows and tells: text, title, language and links."""

    text: str = ""
    title: str = ""
    language: str = ""
    links: list[str] = field(default_factory=list)


class _Finder:
    """``str.find`` that never searches again for what is not there any more."""

    def __init__(self, page: str) -> None:
        self.page, self.gone = page, {}

    def __call__(self, what: str, start: int) -> int:
        if start >= self.gone.get(what, len(self.page) + 1):
            return -1
        at = self.page.find(what, start)
        if at < 0:
            self.gone[what] = start
        return at

    def close(self, name: str, start: int) -> re.Match | None:
        if start >= self.gone.get(name, len(self.page) + 1):
            return None
        found = _CLOSES[name].search(self.page, start)
        if found is None:
            self.gone[name] = start
        return found


def read_page(page: str) -> Page:
    """A page in one pass from left to right, however it is broken.

    A tag ends at the next ``>``; a ``<`` without one is text. Comments, scripts and the
    like that are not closed hide the rest. Every search either moves on or is not made
    again, so the time is that of the length of the page.
    """
    out, find = Page(), _Finder(page)
    shown: list[str] = []
    at = 0
    while True:
        start = find("<", at)
        if start < 0:
            shown.append(page[at:])
            break
        if page.startswith("<!--", start):
            shown += [page[at:start], " "]
            end = find("-->", start + 4)
            if end < 0:
                break
            at = end + 3
            continue
        name = _NAME.match(page, start)
        if name is None:
            shown.append(page[at : start + 1])
            at = start + 1
            continue
        end = find(">", name.end())
        if end < 0:
            # No tag is closed any more; a comment may still hide the rest.
            rest = find("<!--", start)
            shown.append(page[at:] if rest < 0 else page[at:rest])
            break
        shown.append(page[at:start])
        at = end + 1
        kind = (name[1] or "").lower()
        opens = page[start + 1] != "/"
        if kind in _HIDDEN and opens:
            shown.append(" ")
            closing = find.close(kind, at)
            if closing is None:
                break
            at = closing.end()
            continue
        if kind in _BREAK:
            shown.append("\n")
        if opens and kind == "title" and not out.title:
            closing = find.close("title", at)
            if closing is not None:
                out.title = _line(html.unescape(_untagged(page[at : closing.start()])))
        elif opens and kind == "html" and not out.language:
            found = _LANG.search(page, name.end(), end)
            out.language = found[1] if found else ""
        elif opens and kind == "a":
            link = _link(page, name.end(), end, find)
            if link is not None:
                out.links.append(html.unescape(link))
    lines = (x.strip() for x in _RUN.sub(" ", html.unescape("".join(shown))).split("\n"))
    out.text = "\n".join(x for x in lines if x)
    return out


def _untagged(text: str) -> str:
    """Text without what is between ``<`` and ``>``."""
    out, at = [], 0
    while True:
        start = text.find("<", at)
        end = text.find(">", start) if start >= 0 else -1
        if end < 0:
            return "".join([*out, text[at:]])
        out.append(text[at:start])
        at = end + 1


def _link(page: str, start: int, end: int, find: _Finder) -> str | None:
    """Value of ``href`` in a tag; in quotes it may go on after a ``>``."""
    found = _HREF.search(page, start, end)
    if found is None:
        return None
    quote = page[found.end() : found.end() + 1]
    if quote in ("'", '"') and quote:
        close = find(quote, found.end() + 1)
        return None if close < 0 else page[found.end() + 1 : close]
    bare = _BARE.match(page, found.end(), end)
    return bare[0] if bare else None


def plain_text(page: str) -> str:
    """The text a reader sees: no markup, scripts or comments, a line per block."""
    return read_page(page).text


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    """An identifier that is the same whenever it is made from the same parts."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(31).join(parts))}>"


def _line(value: str) -> str:
    return " ".join(value.split())


def _record(headers: list[tuple[str, str]], block: str) -> tuple[str, str, int]:
    """(record without its two closing line ends, block digest, block length)."""
    body = block.encode()
    hashed = digest(body)
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers if v)]
    lines += [f"WARC-Block-Digest: {hashed}", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines) + END + block, hashed, len(body)


def derive(response: dict) -> list[dict]:
    """The metadata and the conversion record of one response."""
    page = response["payload"] or ""
    url, date = response["target_uri"] or "", response["date"] or ""
    source = response["record_id"]
    headers = response["http_headers"] or []
    payload_digest = digest(page.encode())
    read = read_page(page)
    ids = {kind: record_id(kind, source) for kind in ("metadata", "conversion")}
    refers = [
        ("WARC-Refers-To", source), ("WARC-Refers-To-Target-URI", _line(url)),
        ("WARC-Refers-To-Date", date),
    ]
    common = [("WARC-Date", date), ("WARC-Target-URI", _line(url))]
    fields = [
        ("source-payload-digest", payload_digest),
        ("source-content-length", str(len(page.encode()))),
        *((f"source-header-{_line(k).lower()}", _line(v)) for k, v in headers),
        ("title", read.title),
        ("language", read.language),
        ("conversion", ids["conversion"]),
        *(("outlink", _line(x)) for x in read.links),
    ]
    blocks = {
        "metadata": (FIELDS_TYPE, "".join(f"{k}: {v}\r\n" for k, v in fields if v)),
        "conversion": (TEXT_TYPE, read.text),
    }
    out = []
    for kind, (content_type, block) in blocks.items():
        head = [("WARC-Type", kind), ("WARC-Record-ID", ids[kind]), *common, *refers]
        if kind == "conversion":
            # The text is the payload; its link to the fields goes both ways.
            head += [("WARC-Concurrent-To", ids["metadata"])]
        record, hashed, size = _record([*head, ("Content-Type", content_type)], block)
        out.append(
            {
                "warc_type": kind, "warc_record_id": ids[kind], "refers_to": source,
                "target_uri": url, "source_payload_digest": payload_digest,
                "block_digest": hashed, "content_length": size, "block": block, "record": record,
            }
        )
    return out


RESULT = T.StructType(
    [
        T.StructField(n, T.LongType() if n == "content_length" else T.StringType())
        for n in (
            "warc_type", "warc_record_id", "refers_to", "target_uri", "source_payload_digest",
            "block_digest", "content_length", "block", "record",
        )
    ]
)


def _derived(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            made = [derive(r) for r in part.select(
                ["record_id", "target_uri", "date", "http_headers", "payload"]).to_pylist()]
            own = pa.array([i for i, m in enumerate(made) for _ in m])
            flat = [x for m in made for x in m]
            columns = {key: part.column(key).take(own)}
            for f in RESULT.fields:
                kind = pa.int64() if f.name == "content_length" else pa.string()
                columns[f.name] = pa.array([x[f.name] for x in flat], kind)
            yield pa.RecordBatch.from_pydict(columns)


def responses(
    pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html",
    date: str = "2024-01-01T00:00:00Z", content_type: str = "text/html; charset=utf-8",
) -> DataFrame:
    """Pages as response records: key, record_id, target_uri, date, http_headers, payload.

    Identifiers follow from key and URL, so a page has the same one in every run.
    """
    name = F.concat_ws("\x1f", F.lit("response"), F.col(f"`{key}`").cast("string"),
                       F.col(f"`{url}`"))
    hex_ = F.substring(F.sha2(name, 256), 1, 32)
    parts = [F.substring(hex_, a, n) for a, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    urn = F.concat(
        F.lit("<urn:uuid:"), parts[0], F.lit("-"), parts[1], F.lit("-8"), parts[2], F.lit("-8"),
        parts[3], F.lit("-"), parts[4], F.lit(">"),
    )
    header = F.struct(F.lit("Content-Type").alias("name"), F.lit(content_type).alias("value"))
    size = F.struct(
        F.lit("Content-Length").alias("name"),
        F.octet_length(F.coalesce(F.col(f"`{page}`"), F.lit(""))).cast("string").alias("value"),
    )
    return pages.select(
        F.col(f"`{key}`").alias(key), urn.alias("record_id"),
        F.col(f"`{url}`").alias("target_uri"), F.lit(date).alias("date"),
        F.array(header, size).alias("http_headers"), F.col(f"`{page}`").alias("payload"),
    )


def derivatives(records: DataFrame, key: str = "page_id") -> DataFrame:
    """Two rows per response: its metadata and its conversion record.

    ``records`` has the key and ``record_id``, ``target_uri``, ``date``,
    ``http_headers`` (array of name and value) and ``payload``; see :func:`responses`.
    ``record`` is a whole WARC record but for its two closing line ends.

    * A NULL or empty payload gives an empty text and metadata without title.
    * A NULL target or date leaves out the headers made from it; NULL headers count
      as none; a NULL record identifier is an error, as nothing could refer to it.
    * Pages are read whole; unclosed comments, scripts and tags are tolerated.
    * Repeated rows give repeated records; an empty table gives none. Columns of any
      other name are not looked at.
    """
    ship_package(records.sparkSession)
    named = F.coalesce(
        F.col("record_id"), F.raise_error(F.lit("a response without an identifier"))
    )
    headers = F.transform(
        "http_headers",
        lambda h: F.array(F.coalesce(h["name"], F.lit("")), F.coalesce(h["value"], F.lit(""))),
    )
    picked = records.select(
        F.col(f"`{key}`").alias(key), named.alias("record_id"), "target_uri", "date",
        headers.alias("http_headers"), "payload",
    )
    schema = T.StructType([picked.schema[key], *RESULT.fields])
    return picked.mapInArrow(partial(_derived, key=key), schema)


def write_warc(derived: DataFrame, folder: str, compression: str = "gzip") -> str:
    """Write the records as WARC files, one per task, to a folder Spark can reach."""
    (
        derived.select("record").write.option("lineSep", END)
        .option("compression", compression).text(folder)
    )
    return folder


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Records of files of :func:`write_warc`: type, identifiers, digest and block.

    A file is cut where a record begins, so blocks may hold empty lines.
    """
    start = "WARC/1.1\r\nWARC-Type: "
    rows = spark.read.option("lineSep", END + start).text(folder)
    # The first record of a file still has its start, the last its end.
    record = F.regexp_replace(F.regexp_replace("value", "^WARC/1\\.1\r\nWARC-Type: ", ""),
                              "\r\n\r\n$", "")

    def header(name: str) -> Column:
        return F.regexp_extract("head", f"\r\n{name}: ([^\r]*)", 1)

    parts = rows.select(record.alias("r")).select(
        F.substring_index("r", END, 1).alias("head"),
        F.expr("substring(r, instr(r, '\r\n\r\n') + 4)").alias("block"),
    )
    return parts.select(
        F.substring_index("head", "\r\n", 1).alias("warc_type"),
        header("WARC-Record-ID").alias("warc_record_id"),
        header("WARC-Refers-To").alias("refers_to"),
        header("WARC-Block-Digest").alias("block_digest"),
        header("Content-Length").cast("long").alias("content_length"), "block",
    )


def _inflated(data: bytes) -> Iterator[bytes]:
    """A file's bytes by gzip members (each by itself), or as they are."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(wbits=31)
        yield member.decompress(data) + member.flush()
        data = member.unused_data


def frame_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of every record, framed by its Content-Length.

    Members of a gzip file are taken one after the other; a record may go over several.
    A record that is cut short, or whose length is no number, ends the file.
    """
    rest = b""
    for part in _inflated(data):
        rest += part
        at = 0
        while True:
            while rest[at : at + 2] == b"\r\n":
                at += 2
            head = rest.find(b"\r\n\r\n", at)
            if head < 0 or rest[at : at + 5] != b"WARC/":
                break
            lines = rest[at:head].decode("utf-8", "replace").split("\r\n")
            headers: dict[str, str] = {}
            last = ""
            for line in lines[1:]:
                if line[:1] in " \t" and last:
                    headers[last] += " " + line.strip()
                    continue
                last, _, value = line.partition(":")
                last = last.strip().lower()
                headers.setdefault(last, value.strip())
            size = headers.get("content-length", "")
            stop = head + 4 + int(size) if size.isdigit() else len(rest) + 1
            if stop > len(rest):
                break
            yield headers, rest[head + 4 : stop]
            at = stop
        rest = rest[at:]


def _http(block: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """Headers and body of an HTTP response."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"HTTP/"):
        return [], block
    fields = []
    for line in head.decode("latin-1").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields.append((name.strip(), value.strip()))
    return fields, body


def _text(body: bytes, headers: list[tuple[str, str]]) -> str:
    kind = next((v for k, v in headers if k.lower() == "content-type"), "")
    charset = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", kind, re.I)
    try:
        return body.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def _responses(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for batch in batches:
        for path, content in zip(*(batch.column(c) for c in ("path", "content"))):
            for number, (headers, block) in enumerate(frame_records(content.as_py())):
                if headers.get("warc-type") != "response":
                    continue
                fields, body = _http(block)
                out.append((
                    f"{path.as_py()}#{number}", headers.get("warc-record-id"),
                    headers.get("warc-target-uri", "").strip("<>") or None,
                    headers.get("warc-date"),
                    [{"name": k, "value": v} for k, v in fields], _text(body, fields),
                ))
                if len(out) >= 256:
                    yield _rows_of(out, schema)
                    out = []
    if out:
        yield _rows_of(out, schema)


def _rows_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema
    )


def read_responses(spark: SparkSession, path: str, glob: str = "*.warc*") -> DataFrame:
    """Response records of WARC files, in the columns that :func:`derivatives` takes.

    The key ``page_id`` is the file and the record's number in it. Files are plain or
    gzip, also with a member per record, and are read by one task each. Blocks are cut
    by their Content-Length, HTTP headers taken off and kept, and the body decoded by
    the character set they name. Records of other types are passed; what follows a
    broken record in a file is not read. A response without an identifier has NULL.
    """
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    schema = T.StructType.fromDDL(
        "page_id string, record_id string, target_uri string, date string, "
        "http_headers array<struct<name:string,value:string>>, payload string"
    )
    return files.select("path", "content").mapInArrow(
        partial(_responses, schema=to_arrow_schema(schema)), schema
    )
