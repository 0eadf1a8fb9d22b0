"""WARC derivatives: from response records to linked metadata and plain-text conversion records.

A record is its header lines, an empty line and a block, all bytes. Each response gives two records of its own that
refer to it: ``metadata`` (what the response said about itself: status, source headers, payload digest, title, links)
and, where its type is a text type, ``conversion`` (the text of its page). Transfer and content codings are undone first.
Both carry WARC-Refers-To with the response's id, its target and its date,
and digests of their blocks; the response's own digests are kept, or made where it has none.

Records are independent, so this is one map over the table, without a shuffle.
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
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdsift.llm.common import columns, table
from holdsift.llm.htmlmain import Reader

VERSION = "WARC/1.1"
#: Date of responses made from a table that has none.
DATE = "2026-01-01T00:00:00Z"
_HREF = re.compile(r"""<a\s[^>]*?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title", re.I | re.S)
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)
Fields = list[tuple[str, str]]


def digest(data: bytes) -> str:
    """SHA-1 in base 32, as WARC files have it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def record_id(*parts: str) -> str:
    """Same id for the same parts, so that a rerun makes the same records."""
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts)).urn}>"


def write(fields: Fields, block: bytes) -> bytes:
    """Bytes of a record. Line breaks inside a value become spaces; Content-Length is set from the block."""
    lines = [VERSION] + [f"{k}: {re.sub(r'[\r\n]+', ' ', v)}" for k, v in fields if k.lower() != "content-length"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode("utf-8")
    return head + b"\r\n\r\n" + block + b"\r\n\r\n"


def read(record: bytes) -> tuple[Fields, bytes]:
    """Header fields, folded lines joined, and block of a record; ``ValueError`` if it is none."""
    head, empty, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not empty or not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields: Fields = []
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and fields:
            fields[-1] = (fields[-1][0], f"{fields[-1][1]} {line.strip()}")
        else:
            name, _, value = line.partition(":")
            fields.append((name.strip(), value.strip()))
    length = get(fields, "Content-Length")
    if not length.isdigit() or int(length) > len(rest):
        raise ValueError("the block is shorter than its Content-Length")
    return fields, rest[: int(length)]


def get(fields: Fields, name: str) -> str:
    return next((v for k, v in fields if k.lower() == name.lower()), "")


def http_message(block: bytes) -> tuple[str, Fields, bytes]:
    """Status line, headers and payload of an HTTP response."""
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *lines = head.decode("iso-8859-1").split("\r\n")
    return status, [(k.strip(), v.strip()) for k, _, v in (line.partition(":") for line in lines)], payload


def _unchunked(data: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        size = re.match(rb"[ \t]*([0-9A-Fa-f]{1,15})[ \t]*(?:;|\Z)", data[at: max(end, at)])
        if end < 0 or not size:
            raise ValueError("the payload is not in chunks as its Transfer-Encoding says")
        n, at = int(size[1], 16), end + 2
        if n == 0:
            return b"".join(out)
        if data[at + n: at + n + 2] != b"\r\n":
            raise ValueError("a chunk is shorter than its size")
        out.append(data[at: at + n])
        at += n + 2


def _inflated(data: bytes, wraps: tuple[int, ...]) -> bytes:
    """Decompressed, in the first of the wrappings that fits; several members in a row are one text."""
    for wrap in wraps:
        out, rest = [], data
        try:
            while rest:
                member = zlib.decompressobj(wrap)
                out.append(member.decompress(rest))
                if not member.eof:
                    raise zlib.error("incomplete")
                rest = member.unused_data if wrap == 31 else b""
            return b"".join(out)
        except zlib.error as e:
            problem = e
    raise ValueError(f"the payload cannot be decompressed: {problem}")


def decoded(headers: Fields, payload: bytes) -> bytes:
    """Payload without its codings, the last one first; ``ValueError`` for one that cannot be undone."""
    for header in ("Transfer-Encoding", "Content-Encoding"):
        told = ",".join(v for k, v in headers if k.lower() == header.lower())
        for coding in reversed([c.strip().lower() for c in told.split(",") if c.strip()]):
            if coding == "chunked":
                payload = _unchunked(payload)
            elif coding in ("gzip", "x-gzip"):
                payload = _inflated(payload, (31,))
            elif coding == "deflate":  # zlib's wrapping by the rules, none in the practice of some servers
                payload = _inflated(payload, (15, -15))
            elif coding != "identity":
                raise ValueError(f"the coding {coding} cannot be undone")
    return payload


def text_kind(headers: Fields) -> str:
    """``page`` (also where no type is told), ``plain`` for other text types, '' for all else."""
    kind = get(headers, "Content-Type").partition(";")[0].strip().lower()
    if kind in ("", "text/html", "application/xhtml+xml"):
        return "page"
    plain = kind.startswith("text/") or kind in ("application/json", "application/xml", "application/javascript")
    return "plain" if plain or kind.endswith(("+json", "+xml")) and not kind.startswith("image/") else ""


def payload_text(headers: Fields, payload: bytes) -> str:
    found = _CHARSET.search(get(headers, "Content-Type")) or _CHARSET.search(payload[:1024].decode("ascii", "replace"))
    try:
        return payload.decode(found[1] if found else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def derive(record: bytes, reader: Reader) -> list[tuple[str, str, str, bytes]]:
    """(type, id, refers to, record) of the derivatives of a response record; none of a record of another type."""
    fields, block = read(record)
    if get(fields, "WARC-Type") != "response":
        return []
    source, date = get(fields, "WARC-Record-ID"), get(fields, "WARC-Date")
    if not source:
        raise ValueError("a response without WARC-Record-ID cannot be referred to")
    status, headers, payload = http_message(block)
    body, kind_of_text = decoded(headers, payload), text_kind(headers)
    page = payload_text(headers, body) if kind_of_text else ""
    payload_digest = get(fields, "WARC-Payload-Digest") or digest(payload)
    kept = [(k, v) for k, v in fields if k.lower() in ("warc-target-uri", "warc-warcinfo-id", "warc-ip-address")]
    told: Fields = [("status", status), ("source-block-digest", get(fields, "WARC-Block-Digest") or digest(block)),
                    ("source-payload-digest", payload_digest), ("source-length", str(len(payload)))]
    told += [(f"http-{k.lower()}", v) for k, v in headers]
    if kind_of_text == "page":
        title = _TITLE.search(page)
        if title:
            told.append(("title", " ".join(html.unescape(title[1]).split())))
        told += [("outlink", html.unescape(h.strip("\"'"))) for h in _HREF.findall(page)]
    about = "".join(f"{k}: {re.sub(r'[\r\n]+', ' ', v)}\r\n" for k, v in told).encode("utf-8")
    made = [("metadata", "application/warc-fields", about)]
    if kind_of_text:
        text = "\n".join(t for t, _ in reader.blocks(page)) if kind_of_text == "page" else page
        made.append(("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace")))
    out = []
    for kind, content_type, data in made:
        own = record_id(source, kind, digest(data))
        head = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Date", date), *kept, ("WARC-Refers-To", source)]
        if get(fields, "WARC-Target-URI"):
            head.append(("WARC-Refers-To-Target-URI", get(fields, "WARC-Target-URI")))
        head += [("WARC-Refers-To-Date", date), ("WARC-Source-Payload-Digest", payload_digest), ("WARC-Block-Digest", digest(data)),
                 ("Content-Type", content_type)]
        out.append((kind, own, source, write(head, data)))
    return out


def response(page_id: str, url: str | None, payload: bytes, date: str = DATE) -> bytes:
    """A response record around a page."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    head = [("WARC-Type", "response"), ("WARC-Record-ID", record_id("page", page_id, url or "", digest(payload))), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", url))
    head += [("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(block)),
             ("Content-Type", "application/http; msgtype=response")]
    return write(head, block)


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = DATE) -> DataFrame:
    """(source, record): a response record for each page; a null page has an empty payload, a null url no target."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [response(str(i), u, (h or "").encode("utf-8"), date) for i, u, h in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["source", "record"])

    picked = columns(pages, source=id_col, url=url_col, html=html_col)
    return picked.mapInArrow(run, f"source {dict(picked.dtypes)['source']}, record binary")


def derivatives(records: DataFrame, source_col: str = "source", record_col: str = "record") -> DataFrame:
    """(source, type, record_id, refers_to, record, error) of the derivatives of every response record.

    Defined results: records of other types give nothing; a null, truncated or broken record, a response without an id
    and one whose codings cannot be undone (all but chunks, gzip and deflate) give one row with ``error`` and nothing
    else; a response of another than a text type has metadata and no conversion; plain texts are taken as they are; equal responses give equal derivatives; an empty table gives no rows.
    """
    names = ["source", "type", "record_id", "refers_to", "record", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(features=False)
        for batch in batches:
            at, made = [], []
            for i, value in enumerate(batch.column(1)):
                try:
                    rows = [(*d, None) for d in derive(value.as_py() or b"", reader)]
                except ValueError as e:
                    rows = [(None, None, None, None, str(e))]
                at.extend([i] * len(rows))
                made.extend(rows)
            kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.string()]
            cols = list(zip(*made)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(cols, kinds))], names)

    picked = columns(records, source=source_col, record=record_col)
    schema = f"source {dict(picked.dtypes)['source']}, type string, record_id string, refers_to string, record binary, error string"
    return picked.mapInArrow(run, schema)


def op5_warc_derivatives(spark, sf_dir):
    made = derivatives(responses(table(spark, sf_dir, "pages")))
    return made.select(F.col("source").alias("page_id"), "type", "record_id", "refers_to",
                       F.octet_length("record").cast("long").alias("n_bytes"), F.sha2("record", 256).alias("record_sha256"))
