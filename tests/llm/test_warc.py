import gzip
import html
import json
import random
import re
import time
from pathlib import Path
from urllib.parse import urljoin

import pytest

from vitrine.llm import warc

PAGES = [(1, "http://a.org/x", "<html><head><title>T &amp; U</title><style>p{}</style></head><body><p>One <b>two</b></p><p>three&nbsp;four"
          "<script>var a='<p>no</p>'</script><br>five <!-- no --> a < b</p><a href='y?q=1&amp;r=2'>l</a><a href=y>m</a></body></html>"),
         (2, None, None), (3, "http://b.org\r\nX: y", ""), (4, "http://c.org", "<script>never closed <p>x"), (None, "http://d.org", "<p>né\r\n\r\nü"),
         (5, "http://e.org", "<p>same"), (5, "http://e.org", "<p>same"), (6, "http://f.org", "<!-- " * 20_000 + "<p " * 20_000)]


def pages(spark):
    return spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id long, url string, html string, block string, record_id string")


def test_records(spark):
    rows = warc.derivatives(warc.responses(pages(spark))).collect()
    assert len(rows) == 2 * len(PAGES)
    source = {(r.page_id, r.target_uri): r for r in warc.responses(pages(spark)).collect()}
    for r in rows:
        s = source[r.page_id, r.target_uri]
        assert (r.refers_to, r.source_payload_digest, r.source_block_digest, r.record_date) == (
            s.record_id, s.payload_digest, s.block_digest, s.record_date)
        assert r.content_length == len(r.block.encode()) and r.block_digest == warc.sha1(r.block.encode())
        assert f"WARC-Refers-To: {s.record_id}\r\n" in r.header and r.header.endswith("\r\n\r\n")
        assert all(line.count(": ") >= 1 for line in r.header.split("\r\n")[1:-2])
    by = {(r.page_id, r.record_type): r for r in rows}
    assert by[1, "conversion"].block == "T & U\nOne two\nthree four\nfive a < b\nlm"
    assert by[1, "conversion"].concurrent_to == by[1, "metadata"].record_id and by[1, "metadata"].concurrent_to == by[1, "conversion"].record_id
    meta = json.loads(by[1, "metadata"].block)
    assert meta["links"] == ["http://a.org/y?q=1&r=2", "http://a.org/y"] and meta["title"] == "T & U"
    assert meta["http_status"] == "HTTP/1.1 200 OK" and ["Content-Type", "text/html; charset=utf-8"] in meta["http_headers"]
    assert by[2, "conversion"].block == by[3, "conversion"].block == by[4, "conversion"].block == ""
    assert by[None, "conversion"].block == "né ü"
    assert warc.derivatives(warc.responses(pages(spark).filter("false"))).count() == 0


def test_other_responses(spark):
    raw = "é".encode("latin-1")
    blocks = [b"HTTP/1.1 404 Not Found\r\nContent-Type: text/html; charset=latin-1\r\nX-Long: a\r\n b\r\n\r\n<p>" + raw, b"no header " + raw, b"", None]
    given = spark.createDataFrame([(i, f"<urn:uuid:{i}>", None, None, None, None, None if b is None else bytearray(b)) for i, b in enumerate(blocks)], warc.RESPONSE)
    got = {(r.page_id, r.record_type): r for r in warc.derivatives(given).collect()}
    assert got[0, "conversion"].block == "é" and got[1, "conversion"].block == "no header �"
    assert json.loads(got[0, "metadata"].block)["http_headers"][1] == ["X-Long", "a b"]
    assert got[2, "conversion"].block == got[3, "conversion"].block == ""
    assert "Target-URI" not in got[0, "metadata"].header


def test_files_round_trip(spark, tmp_path):
    records = warc.derivatives(warc.responses(spark.read.parquet("/root/testdata/sf0.001/pages.parquet").unionByName(
        pages(spark).select("page_id", "url", "html"))))
    warc.write_warc(records, str(tmp_path / "w"))
    found = []
    for file in Path(tmp_path / "w").glob("*.gz"):
        data = gzip.decompress(file.read_bytes())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            size = int(fields["Content-Length"])
            block, data = rest[:size], rest[size:]
            assert data.startswith(b"\r\n\r\n") and warc.sha1(block) == fields["WARC-Block-Digest"]
            data = data[4:]
            found.append((fields["WARC-Record-ID"], fields["WARC-Type"], block.decode()))
    assert sorted(found) == sorted((r.record_id, r.record_type, r.block) for r in records.collect())


def test_tags_that_drop_nothing_after_them():
    """A self-closed svg is empty, and a custom element is not the element its name begins with."""
    for tag in ("<svg/>", '<svg class="i" />', "<SVG viewBox='0 0 1 1'/>", "<svg-icon name=x></svg-icon>", "<template-card>",
                "<style-guide/>", "<textarea-x></textarea-x>", "<script-a>", "<noscript-b>"):
        page = f"<p>one {tag} two</p><title>T</title><p>three <a href=/y>l</a>"
        assert warc.plain_text(page) == "one two\nT\nthree l", tag
        made = {r["record_type"]: r for r in warc.derive(dict.fromkeys(("page_id", "record_id", "record_date", "payload_digest", "block_digest"))
                                                         | {"target_uri": "http://a.org/x", "block": page.encode()})}
        meta = json.loads(made["metadata"]["block"])
        assert (meta["title"], meta["links"]) == ("T", ["http://a.org/y"]), tag
    for gone in ("<svg><title>no</title></svg>", "<svg\nwidth=1><svg/>no</svg >", "<template>no<template-card>no</template>",
                 "<style>no</style-x>no</style>", "<script src=x>no</script\n>", "<textarea/>no</textarea>"):
        assert warc.plain_text(f"one {gone} two") == "one two", gone
    assert warc.plain_text("one <svg no") == warc.plain_text("one <style") == "one"
    assert warc.plain_text("<title-bar>a</title-bar>") == "a" and warc.TITLE.search("<title-bar>a") is None


def slow_links(page, base):
    """A character at a time: tags end at the next '>', a link is the first href with white space before it."""
    found, i = [], 0
    while i < len(page):
        name = next((n for n in ("area", "link", "a") if page[i:i + 1 + len(n)].lower() == "<" + n
                     and not (page[i + 1 + len(n):i + 2 + len(n)] or " ").replace("_", "a").isalnum()), None)
        if name is None:
            i += 1
            continue
        end = i
        while end < len(page) and page[end] != ">":
            end += 1
        at, j = None, i
        while j < end and at is None:
            if page[j].isspace() and page[j + 1:j + 5].lower() == "href":
                k = j + 5
                while k < end and page[k].isspace():
                    k += 1
                if k < end and page[k] == "=":
                    k += 1
                    while k < min(end + 1, len(page)) and page[k].isspace():
                        k += 1
                    at = k
            j += 1
        i = min(end + 1, len(page))
        if at is None or at >= len(page):
            continue
        stop = at
        if page[at] in "\"'":
            stop = at + 1
            while stop < len(page) and page[stop] != page[at]:
                stop += 1
            if stop == len(page):
                continue
            value, stop = page[at + 1:stop], stop + 1
        else:
            while stop < len(page) and not page[stop].isspace() and page[stop] not in "\"'>":
                stop += 1
            value = page[at:stop]
            if not value:
                continue
        i = max(i, stop)
        target = html.unescape(value).strip()
        try:
            target = urljoin(base, target)
        except ValueError:
            pass
        if target not in found:
            found.append(target)
    return found


def slow_text(page):
    """A character at a time, for pages without what ``DROPPED`` takes out: block tags become line ends, wherever
    they begin; then the other tags go."""
    blocks = re.search(r"\?:(.*?)\)", warc.BREAK.pattern, re.S)[1].replace("h[1-6]", "h1|h2|h3|h4|h5|h6").split("|")

    def cut(page, is_tag, put):
        out, i = [], 0
        while i < len(page):
            if page[i] == "<" and is_tag(page[i + 1:i + 20]):
                end = page.find(">", i)
                i = len(page) if end < 0 else end + 1
                out.append(put)
            else:
                out.append(page[i])
                i += 1
        return "".join(out)

    def block(after):
        after = after.removeprefix("/").lower()
        return any(after.startswith(n) and not (after[len(n):len(n) + 1] or " ").replace("_", "a").isalnum() for n in blocks)

    page = "".join(" " if c.isspace() else c for c in page)
    out = cut(cut(page, block, "\n"), lambda x: x[:1] in tuple("/!?") or (x[:1].isascii() and x[:1].isalpha()), "")
    lines = [" ".join(line.split()) for line in html.unescape(out).split("\n")]
    return "\n".join(x for x in lines if x)


def test_pages_against_slow_scans(spark):
    rng = random.Random(4)
    bits = ["<a ", "<a\n", "<A HREF=", " href=", "href = ", "'x y'", '"u?a=1&amp;b"', "v", ">", "</a>", "<area ", "<link\t", "<abbr ", "<a-b ",
            "<p>", "</div >", "<b>", "text", " & ", "&lt;", "\u00a0", "é", "<br/>", "\"", "'", "< ", "/", "<h2 class=z>", "\n", "<!x>", "data-href=q "]
    cases = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    cases += [warc.DROPPED.sub(" ", r.html or "") for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    for page in cases:
        assert warc.links_of(page, "http://a.org/b/") == slow_links(page, "http://a.org/b/"), page
        assert warc.plain_text(page) == slow_text(page), page


@pytest.mark.parametrize("bit", ["<a ", "<a href=", "<a href='", '<a href=">', "<title ", "<title>", "<p ", "<!-- ", "<svg ", "<script ", "</title ", "&#"])
def test_a_million_bytes_of_open_tags(bit):
    page = bit * (1_000_000 // len(bit))
    start = time.process_time()
    warc.links_of(page, "http://a.org/")
    warc.title_of(page)
    assert time.process_time() - start < 1
    warc.plain_text(page)
    assert time.process_time() - start < 3
