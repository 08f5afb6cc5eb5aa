"""Pages in linear time, and response records of WARC files."""

import gzip
import time

import pytest

from tamiz.llm.warc import derivatives, frame_records, plain_text, read_page, read_responses


@pytest.mark.parametrize(
    "piece",
    ["<a ", "<a href", "<a href='", '<a href="', "<title>", "<html ", "<script ", "<script>", "<!--", "<", "</", "<x>",
     "<a href=x>", "lang = ", "<html lang ", "<title>a</title>", "&amp", "href = ", "<a  href =  "],
)
def test_a_megabyte_takes_a_moment(piece):
    page = piece * (1_000_000 // len(piece))
    start = time.process_time()
    read_page(page)
    assert time.process_time() - start < 3


def test_what_a_page_tells():
    page = (
        "<!DOCTYPE html><HTML class=x lang='es-EC'><head><title> A &amp; <b>B</b>\n</title><style>p{}</style>"
        "<script>if (a < b) document.write('<p>no</p>')</SCRIPT ></head><body><h1>Head</h1><p>one <b>two</b>"
        "<!-- <p>hidden</p> --> three<br>four</p><a href=\"u?a=1&amp;b=2\">L</a><A HREF='v>w'>M</A><a name=n>N</a>"
        "<a href=plain>O</a><noscript>off</noscript> 1 < 2 </body>"
    )
    read = read_page(page)
    assert read.title == "A & B" and read.language == "es-EC"
    assert read.links == ["u?a=1&b=2", "v>w", "plain"]
    assert read.text.split("\n")[:4] == ["A & B", "Head", "one two three", "four"]
    assert "hidden" not in read.text and "off" not in read.text and "1 < 2" in read.text


def test_broken_pages():
    assert plain_text("") == "" and plain_text("a < b") == "a < b"
    assert plain_text("a <!-- b") == "a" and plain_text("a <script> b") == "a"
    assert plain_text("x <b y") == "x <b y" and plain_text("x <b <!-- y") == "x <b"
    assert read_page("<title>never closed <title> nor this").title == ""
    assert read_page("<a href='x>y").links == []


def response(uri, body, kind="text/html; charset=utf-8", type_="response", extra=""):
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: {kind}\r\nServer: s\r\n\r\n").encode() + body
    head = (
        f"WARC/1.0\r\nWARC-Type: {type_}\r\nWARC-Record-ID: <urn:uuid:{uri}>\r\nWARC-Date: 2024-01-0{len(uri)}T00:00:00Z\r\n"
        f"WARC-Target-URI: http://{uri}/\r\n{extra}Content-Length: {len(block)}\r\n\r\n"
    ).encode()
    return head + block + b"\r\n\r\n"


RECORDS = [
    response("a", "<p>one ñ</p>\r\n\r\nWARC/1.0 in the text".encode()), response("bb", b"", type_="request"),
    response("ccc", "<p>dos ñ</p>".encode("latin-1"), "text/html; charset=ISO-8859-1"),
    response("dddd", b"\xff<p>x</p>", "text/html; charset=none-such", extra="X-Folded: a\r\n  b\r\n"),
]


@pytest.mark.parametrize("how", ["plain", "members", "one member", "split"])
def test_files_of_responses(spark, tmp_path, how):
    data = b"".join(RECORDS)
    packed = {
        "plain": data, "members": b"".join(gzip.compress(r) for r in RECORDS), "one member": gzip.compress(data),
        "split": gzip.compress(data[:333]) + gzip.compress(data[333:]),
    }[how]
    name = "a.warc" if how == "plain" else "a.warc.gz"
    (tmp_path / name).write_bytes(packed)
    (tmp_path / "b.warc").write_bytes(data[:-30])  # cut short: its last record is passed over
    (tmp_path / "none.warc").write_bytes(b"")
    found = {r["page_id"].split("/")[-1]: r for r in read_responses(spark, f"file://{tmp_path}").collect()}
    assert set(found) == {f"{name}#0", f"{name}#2", f"{name}#3", "b.warc#0", "b.warc#2"}
    one, two, odd = (found[f"{name}#{i}"] for i in (0, 2, 3))
    assert one["payload"] == "<p>one ñ</p>\r\n\r\nWARC/1.0 in the text" and two["payload"] == "<p>dos ñ</p>"
    assert (one["record_id"], one["target_uri"], one["date"]) == ("<urn:uuid:a>", "http://a/", "2024-01-01T00:00:00Z")
    assert [h["name"] for h in one["http_headers"]] == ["Content-Type", "Server"] and odd["payload"].endswith("<p>x</p>")
    made = derivatives(read_responses(spark, f"file://{tmp_path}", name)).collect()
    assert len(made) == 6
    text = {r["refers_to"]: r["block"] for r in made if r["warc_type"] == "conversion"}
    assert text["<urn:uuid:ccc>"] == "dos ñ"
    fields = {r["refers_to"]: r["block"] for r in made if r["warc_type"] == "metadata"}
    assert "source-header-server: s\r\n" in fields["<urn:uuid:a>"]
    for r in made:
        (headers, block), = frame_records((r["record"] + "\r\n\r\n").encode())
        assert headers["warc-refers-to"] == r["refers_to"] and block.decode() == r["block"]


def test_records_that_are_no_records():
    assert list(frame_records(b"")) == [] and list(frame_records(b"no warc\r\n\r\n")) == []
    assert list(frame_records(b"WARC/1.0\r\nContent-Length: x\r\n\r\nabc")) == []
