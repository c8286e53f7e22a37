import base64
import hashlib
import html
import re
from html.parser import HTMLParser

from tessera.llm import warc
from tests.conftest import SF001

PAGE = """<!DOCTYPE html><HTML LANG='de-AT'><head><title>A &amp; B
 c</title><style>p{x:"<p>"}</style><script>if (a<b) { "</p>" }</script></head><body><!-- <p>no</p> -->
<p>One <b>two</b>&nbsp;three<br>four</p><div>5 &lt; 6 <a href="/x?a=1&amp;b=2">link</a><a title="a>b" href='y'>y</a><A HREF=z>z</A><a href="y">again</a></div>
<p class="q>r">last</p></body></html>"""


def sha1(text):
    return "sha1:" + base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def fields(text):
    return [tuple(x.split(": ", 1)) for x in text.split("\r\n") if ": " in x]


def test_text_title_and_links():
    assert warc.plain_text(PAGE) == "A & B\nc\nOne two three\nfour\n5 < 6 linkyzagain\nlast"
    assert warc.title(PAGE) == "A & B c"
    assert warc.links(PAGE) == ["/x?a=1&b=2", "y", "z"]
    assert warc.plain_text("") == "" and warc.plain_text("a < b <unclosed") == "a < b"
    assert len(warc.plain_text("<p>" * 50_000 + "x" + "<a '" * 50_000)) <= 2


def test_linked_records(spark):
    rows = [(1, "http://h/a", PAGE), (1, "http://h/a", PAGE), (2, None, None), (None, "http://h/b\r\nWARC-Type: x", ""), (3, "http://h/c", "<p>" + "x " * 300_000)]
    pages = spark.createDataFrame([(*r, "mine") for r in rows], "page_id long, url string, html string, header string")
    answers = warc.responses(pages)
    ids = {(r.source_id, r.uri): r.record_id for r in answers.collect()}
    assert len(set(ids.values())) == 4
    out = warc.derive(answers).collect()
    assert len(out) == 2 * len(rows) and {r.type for r in out} == {"metadata", "conversion"}
    for r in out:
        page = next(p or "" for i, u, p in rows if (i, u) == (r.source_id, r.uri))
        assert r.refers_to == ids[r.source_id, r.uri] and r.source_digest == sha1(page)
        assert r.block_digest == sha1(r.block) and r.content_length == len(r.block.encode())
        head = dict(fields(r.header))
        assert head["WARC-Type"] == r.type and head["WARC-Refers-To"] == r.refers_to and head["WARC-Record-ID"] == r.record_id
        assert len(fields(r.header)) == len(head)            # a line break in a url makes no header
        assert ("WARC-Target-URI" in head) == (r.uri is not None)
        if r.type == "conversion":
            assert r.block == warc.plain_text(page)
        else:
            assert ("source-http", "Content-Type: text/html; charset=utf-8") in fields(r.block)
    assert warc.derive(answers.limit(0)).count() == 0


def test_files_come_back(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", PAGE * (i % 4) + f"<p>é {i}\n\n</p>") for i in range(20)], "page_id long, url string, html string")
    made = warc.derive(warc.responses(pages))
    warc.write_warc(made.repartition(3), str(tmp_path / "w"))
    back = warc.read_warc(spark, str(tmp_path / "w")).collect()
    assert all(r.whole for r in back)
    assert sorted((r.header, r.block) for r in back) == sorted((r.header, r.block) for r in made.collect())


def test_foreign_records_by_their_length(spark, tmp_path):
    """Blocks that hold the line that begins a record, in the middle, at the ends and twice; a file that is cut off."""
    blocks = [b"one", b"x WARC/1.1\r\nfalse\r\n\r\nmore", b"WARC/1.1\r\n", b"", b"a\r\n\r\n", b"WARC/1.1\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nz",
              "é\n".encode() * 2000 + b"WARC/1.1\r\n"]
    record = lambda i, b: b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (i, len(b), b)
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "plain.warc").write_bytes(record(90, b"fine") + record(91, b"also"))
    (tmp_path / "w" / "torn.warc").write_bytes(b"".join(record(i, b) for i, b in enumerate(blocks)))
    (tmp_path / "w" / "cut.warc").write_bytes(record(92, b"kept") + record(93, b"x" * 50)[:-30])
    for split in ("128m", "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            got = {int(re.search("<(\\d+)>", r.header)[1]): (r.block, r.whole) for r in warc.read_warc(spark, str(tmp_path / "w")).collect()}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert got == {**{i: (b.decode(), True) for i, b in enumerate(blocks)}, 90: ("fine", True), 91: ("also", True), 92: ("kept", True),
                       93: ("x" * 24, False)}
    (tmp_path / "none").mkdir()
    assert warc.read_warc(spark, str(tmp_path / "none")).count() == 0


class Plain(HTMLParser):
    """Words of a page by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.off, self.words = 0, []

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style")

    def handle_data(self, data):
        if not self.off:
            self.words.append(data)


def test_query_against_a_parser(spark):
    from tessera.llm.queries import QUERIES
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    out = QUERIES["op8_warc_derivatives"](spark, SF001).collect()
    assert len(out) == 2 * len(pages)
    for r in out:
        if r.type == "conversion":
            parser = Plain()
            parser.feed(pages[r.page_id].html)
            assert "".join(r.block.split()) == "".join("".join(parser.words).split())
        assert r.source_digest == sha1(pages[r.page_id].html) and html.unescape(r.uri) == r.uri
