"""WARC derivatives: a metadata and a plain-text conversion record for each HTTP response.

Both name the response in WARC-Refers-To and each other in WARC-Concurrent-To, keep its target URI
and date, and carry the digest of their own block. The metadata record holds what the text drops: the
response's record id, its digests as the response gave them, the HTTP status and header fields, the
title and the links. Record ids come from the response's id and the kind, so a task that runs again
writes the same records.
"""
from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("5b0c4a76-61d5-5c53-8e0f-0f3f6d1ad1a5")    # fixed value: any constant will do

RESPONSE = ("page_id long, record_id string, target_uri string, record_date string, payload_digest string, "
            "block_digest string, block binary")
DERIVED = ("page_id long, record_type string, record_id string, refers_to string, concurrent_to string, "
           "target_uri string, record_date string, content_type string, content_length long, block_digest string, "
           "source_payload_digest string, source_block_digest string, header string, block string")

# a name ends at white space, '/' or '>', so <svg-icon> is another element; of these only svg can close itself
DROPPED = re.compile(r"<!--.*?(?:-->|\Z)|<svg(?:/|\s[^>]*/)>"
                     r"|<(script|style|noscript|template|svg|textarea)(?=[\s/>]|\Z)[^>]*(?:>|\Z).*?(?:</\1(?=[\s/>])[^>]*>|\Z)",
                     re.S | re.I)
# tags end at the next '>' or with the page, so a search that begins at one never fails behind it
TITLE, TITLE_END = re.compile(r"<title(?=[\s/>])[^>]*(?:>|\Z)", re.I), re.compile(r"</title\s*>", re.I)
BREAK = re.compile(r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|figure|footer|form|h[1-6]|head|header|"
                   r"hr|html|li|main|nav|ol|option|p|pre|section|table|tbody|td|th|thead|title|tr|ul)\b[^>]*(?:>|\Z)", re.I)
TAG = re.compile(r"<[a-zA-Z/!?][^>]*(?:>|\Z)")
LINK = re.compile(r"<(?:a|area|link)\b[^>]*(?:>|\Z)", re.I)
HREF = re.compile(r"\shref\s*=\s*", re.I)
VALUE = re.compile(r"""(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
CHARSET = re.compile(r"charset\s*=\s*\"?([\w.:-]+)", re.I)


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date: str = DATE) -> DataFrame:
    """Response records of stored pages: an HTTP message around each page's HTML (null: empty)."""
    body = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("body").cast("string"), F.lit("\r\n\r\n"))
    name = F.md5(F.concat_ws("\n", F.col("page_id").cast("string"), "target_uri", F.sha2("body", 256)))
    parts = [F.substring(name, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("target_uri"),
                         body.alias("body"))
            .withColumn("block", F.concat(head.cast("binary"), F.col("body")))
            .select("page_id", F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")).alias("record_id"),
                    "target_uri", F.lit(date).alias("record_date"),
                    F.concat(F.lit("sha256:"), F.sha2("body", 256)).alias("payload_digest"),
                    F.concat(F.lit("sha256:"), F.sha2("block", 256)).alias("block_digest"), "block"))


def parse_http(block: bytes) -> tuple[str, list[list[str]], bytes]:
    """(status line, header fields, body); a block without a header is all body."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"HTTP/"):
        return "", [], block
    lines = head.decode("latin-1").split("\r\n")
    fields: list[list[str]] = []
    for line in lines[1:]:
        if line[:1] in " \t" and fields:                 # a folded field goes on
            fields[-1][1] += " " + line.strip()
        else:
            name, _, value = line.partition(":")
            fields.append([name.strip(), value.strip()])
    return lines[0], fields, body


def decoded(body: bytes, fields: list[list[str]]) -> str:
    """The body by the charset of its content type, UTF-8 where that is missing or unknown."""
    kind = next((v for n, v in fields if n.lower() == "content-type"), "")
    named = CHARSET.search(kind)
    try:
        return body.decode(named[1] if named else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def plain_text(page: str) -> str:
    """The page's text: block elements end lines, scripts, styles and comments are dropped, character
    references resolved, white space within lines folded and empty lines left out."""
    page = DROPPED.sub(" ", page)
    page = re.sub(r"\s+", " ", page)
    text = html.unescape(TAG.sub("", BREAK.sub("\n", page)))
    return "\n".join(x for x in (" ".join(line.split()) for line in text.split("\n")) if x)


def title_of(page: str) -> str | None:
    """The text of the first title element, with references resolved and white space folded; None without one."""
    page = DROPPED.sub(" ", page)
    tag = TITLE.search(page)
    if not tag or not tag[0].endswith(">"):
        return None
    end = TITLE_END.search(page, tag.end())
    return " ".join(html.unescape(TAG.sub("", page[tag.end():end.start() if end else len(page)])).split())


def links_of(page: str, base: str) -> list[str]:
    """Targets of the page's links against its own address, each once, in order. Of a tag the first target counts;
    one in quotes may hold a '>'. The page is read once, however many tags are left open."""
    found, page, at = {}, DROPPED.sub(" ", page), 0
    while tag := LINK.search(page, at):
        at = tag.end()
        name = HREF.search(page, tag.start(), tag.end())
        value = name and VALUE.match(page, name.end())
        if not value:
            continue
        at = max(at, value.end())
        target = html.unescape(next(x for x in value.groups() if x is not None)).strip()
        try:
            target = urljoin(base, target)
        except ValueError:
            pass
        found[target] = None
    return list(found)


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(source: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{kind} {source}')}>"


def one_line(value: str) -> str:
    """A header value without line ends."""
    return re.sub(r"[\r\n]+", " ", value)


def derive(source: dict) -> list[dict]:
    """The metadata and conversion records of one response."""
    status, fields, body = parse_http(source["block"] or b"")
    page = decoded(body, fields)
    uri, origin = source["target_uri"], source["record_id"] or ""
    meta = {"refers_to": origin, "payload_digest": source["payload_digest"], "block_digest": source["block_digest"],
            "http_status": status, "http_headers": fields,
            "title": title_of(page), "links": links_of(page, uri or "")}
    blocks = {"metadata": ("application/json", json.dumps(meta, ensure_ascii=False)),
              "conversion": ("text/plain; charset=utf-8", plain_text(page))}
    ids = {kind: record_id(origin, kind) for kind in blocks}
    out = []
    for kind, (content_type, block) in blocks.items():
        data = block.encode("utf-8", "replace")
        other = ids["conversion" if kind == "metadata" else "metadata"]
        row = {"record_type": kind, "record_id": ids[kind], "refers_to": origin, "concurrent_to": other, "target_uri": uri,
               "record_date": source["record_date"], "content_type": content_type, "content_length": len(data),
               "block_digest": sha1(data), "source_payload_digest": source["payload_digest"],
               "source_block_digest": source["block_digest"]}
        named = (("WARC-Type", kind), ("WARC-Record-ID", ids[kind]), ("WARC-Refers-To", origin), ("WARC-Concurrent-To", other),
                 ("WARC-Target-URI", uri), ("WARC-Date", source["record_date"]), ("WARC-Block-Digest", row["block_digest"]),
                 ("Content-Type", content_type), ("Content-Length", str(len(data))))
        row["header"] = "\r\n".join([VERSION, *(f"{n}: {one_line(v)}" for n, v in named if v)]) + "\r\n\r\n"
        out.append(row | {"page_id": source["page_id"], "block": data.decode()})
    return out


def derivatives(records: DataFrame) -> DataFrame:
    """Two rows, metadata and conversion, for each of ``records`` (columns of ``RESPONSE``).

    A null block is empty: its conversion has no text. A null URI or date leaves its header line out.
    Repeated responses give repeated records with equal ids. An empty table gives none; other columns
    are not looked at.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(DERIVED)
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "block"):
                yield pa.RecordBatch.from_pylist([r for source in part.to_pylist() for r in derive(source)], out)

    wanted = [F.col(x.split()[0]).cast(x.split()[1]) for x in RESPONSE.split(", ")]
    return records.select(*wanted).mapInArrow(run, schema)


def write_warc(records: DataFrame, path: str) -> None:
    """Derived records as gzipped WARC files below ``path``, one for each task, through Spark's writer."""
    (records.select(F.concat("header", "block", F.lit("\r\n")).alias("value"))
     .write.option("lineSep", "\r\n").option("compression", "gzip").text(path))
