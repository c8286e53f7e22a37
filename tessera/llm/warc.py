"""WARC derivatives (operator 8).

Each response record gives two more: a metadata record (title, language, links, and the
source's HTTP headers, as warc-fields) and a conversion record (the page's plain text).
Both refer to the response by WARC-Refers-To, keep its target, date and payload digest,
and carry digests of their own. Every record is made from one response alone, so there is
nothing to shuffle and no group that could grow.
"""

from __future__ import annotations

import hashlib
import html
import re
import uuid
from base64 import b32encode

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import slices, text_bytes

VERSION, END = "WARC/1.1", "\r\n"

# a tag goes on to its end or the text's: each pattern passes over a text once, whatever it holds
_inside = r"""(?:[^>=]+|=\s*"[^"]*(?:"|\Z)|=\s*'[^']*(?:'|\Z)|=)*+"""
_dropped = re.compile(rf"<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b{_inside}(?:>|\Z).*?(?:</\1\s*>|\Z)", re.S | re.I)
_head_title = re.compile(rf"<title\b{_inside}>(.*?)(?:</title\s*>|\Z)", re.S | re.I)
_block = re.compile(rf"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|figcaption|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul)\b{_inside}(?:>|\Z)", re.I)
_tag = re.compile(rf"<[!/?a-z]{_inside}(?:>|\Z)", re.I)
_anchor = re.compile(rf"<a\s{_inside}(?:>|\Z)", re.I)
_attribute = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*("[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^\s>"']+))?""")
_lang = re.compile(r"""<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z-]+)""", re.I)
_blank = re.compile(r"[^\S\n]+")


def plain_text(page: str) -> str:
    """A page's text: a line for each block, without markup, scripts, styles and comments."""
    text = _block.sub("\n", _dropped.sub(" ", page))
    if "<" in text:
        text = _tag.sub("", text)
    lines = (_blank.sub(" ", x).strip() for x in html.unescape(text).split("\n"))
    return "\n".join(x for x in lines if x)


def title(page: str) -> str:
    found = _head_title.search(page)
    return plain_text(found[1]).replace("\n", " ") if found else ""


def links(page: str) -> list[str]:
    """Targets of a page's links as they stand, in order, each once."""
    found = (value for tag in _anchor.findall(_dropped.sub(" ", page))
             for value in [next((v for k, v in _attribute.findall(tag[2:]) if k.lower() == "href"), "")])
    clean = (html.unescape(x[1:].rstrip(x[0]) if x[:1] in ("'", '"') else x).strip() for x in found)
    return list(dict.fromkeys(x for x in clean if x))


def sha1(data: bytes) -> str:
    return "sha1:" + b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: object) -> str:
    """An identifier that is the same whenever it is made from the same parts."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


def one_line(value: str) -> str:
    """A header's value: a line break within it would begin another header."""
    return re.sub(r"[\r\n\t ]+", " ", value).strip()


def header(fields: list[tuple[str, object]]) -> str:
    """A record's header without its closing empty line; fields without a value are left out."""
    return END.join([VERSION, *(f"{k}: {one_line(str(v))}" for k, v in fields if v not in (None, ""))])


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date: str = "1970-01-01T00:00:00Z", http: str = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8") -> DataFrame:
    """Response rows (source_id, record_id, uri, date, http, payload) of stored pages.

    Pages have no fetch time or headers of their own, so ``date`` and ``http`` are given.
    A null page is an empty payload, a null url no target. The identifier is made of the
    page's id, url and payload: pages that are the same in all three have the same one.
    """
    hashed = F.sha1(F.concat_ws("|", F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")),
                                F.coalesce(F.col(f"`{url_col}`"), F.lit("")), F.coalesce(F.col(f"`{html_col}`"), F.lit(""))))
    part = lambda a, n: F.substring(hashed, a, n)
    name = F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)), F.lit(">"))
    return pages.select(F.col(f"`{id_col}`").alias("source_id"), name.alias("record_id"), F.col(f"`{url_col}`").alias("uri"),
                        F.lit(date).alias("date"), F.lit(http).alias("http"), F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("payload"))


FIELDS = ("record_id string, type string, refers_to string, uri string, date string, content_type string, "
          "content_length long, block_digest string, source_digest string, header string, block string")


def derive(rows: DataFrame) -> DataFrame:
    """The metadata and the conversion record of each response row, with source_id.

    Columns: record_id, type, refers_to, uri, date, content_type, content_length (bytes of
    the block), block_digest, source_digest (of the response's payload), header, block. A
    null payload counts as empty and has an empty text; null fields are left out of
    headers. Repeated responses give repeated records.
    """
    kind = rows.schema["source_id"].dataType.simpleString()
    names = ["source_id", *(f.split()[0] for f in FIELDS.split(", "))]
    rows = rows.select("source_id", "record_id", "uri", "date", "http", "payload")

    def made(source, of, uri, date, http, payload):
        page = payload or ""
        digest = sha1(page.encode())
        about = [("title", title(page))]
        if found := _lang.search(page):
            about.append(("language", found[1]))
        about += [("outlink", x) for x in links(page)]
        about += [("source-http", x) for x in (http or "").split(END) if x]
        about.append(("source-payload-digest", digest))
        fields = "".join(f"{k}: {one_line(v)}{END}" for k, v in about if v)
        for type_, content, block in (("metadata", "application/warc-fields", fields), ("conversion", "text/plain; charset=utf-8", plain_text(page))):
            data, own = block.encode(), record_id(type_, of)
            own_digest = sha1(data)
            yield (source, own, type_, of, uri, date, content, len(data), own_digest, digest, header([
                ("WARC-Type", type_), ("WARC-Record-ID", own), ("WARC-Refers-To", of), ("WARC-Target-URI", uri), ("WARC-Date", date),
                ("WARC-Block-Digest", own_digest), ("WARC-Source-Payload-Digest", digest), ("Content-Type", content), ("Content-Length", len(data))]), block)

    def run(batches):
        for batch in batches:
            for a, b in slices(batch, text_bytes(batch, "payload")):
                part = batch.slice(a, b - a)
                out = [r for row in zip(*(c.to_pylist() for c in part.columns)) for r in made(*row)]
                types = [part.schema.field("source_id").type, *[pa.int64() if n == "content_length" else pa.string() for n in names[1:]]]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)

    return rows.mapInArrow(run, f"source_id {kind}, {FIELDS}")


def record(head: Column, block: Column) -> Column:
    return F.concat(head, F.lit(END + END), block)


def write_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """Records (header, block) as WARC files, one for each partition."""
    (records.select(record(F.col("header"), F.col("block")).alias("value"))
     .write.option("lineSep", END + END).option("compression", compression).text(path))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """header, block and whole (the block is as long as its header says) of the records in WARC files.

    Files are split where a line begins a record. Where that is within a block, as a foreign
    record may hold such a line itself, lengths disagree; the pieces of such a file are put
    together in their order, by Content-Length, in one pass over them. Records that are still
    not as long as they say (a file that is cut off) have whole false. Bytes that are no UTF-8
    become U+FFFD in header and block.
    """
    pieces = spark.read.option("lineSep", VERSION + END).text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"))
    torn = pieces.mapInArrow(_lengths, "file string, torn boolean").where("torn").select("file").distinct()
    plain = pieces.join(torn, "file", "left_anti").select("file", "value")
    # a file's pieces in their order, streamed through one task
    again = pieces.join(torn, "file", "left_semi").repartition("file").sortWithinPartitions("file", "start", "n").select("file", "value")
    kind = "header string, block string, whole boolean"
    return plain.mapInArrow(_records(False), kind).unionByName(again.mapInArrow(_records(True), kind))


_length = re.compile(rb"(?i)(?:^|\r\n)Content-Length: *([0-9]+)")


def _parts(data: bytes) -> tuple[bytes, bytes, int]:
    """Header and rest of a piece, and how many bytes the rest lacks (below 0: too many)."""
    head, _, rest = data.partition(END.encode() * 2)
    stated = _length.search(head)
    return head, rest, int(stated[1]) - len(rest) if stated else 0


def _lengths(batches):
    """Whether a file has a piece that isn't a whole record."""
    for batch in batches:
        found = []
        for value in batch.column("value").to_pylist():
            lacks = _parts(value)[2] if value else 0
            found.append(lacks not in (0, -2 * len(END)))
        yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(found, pa.bool_())], names=["file", "torn"])


def _records(join: bool):
    """What turns pieces into records; with ``join`` a piece takes the next ones until it is as long as it says."""

    def record_of(data: bytes) -> tuple[str, str, bool]:
        head, rest, lacks = _parts(data)
        end = len(rest) + lacks if lacks <= 0 and _length.search(head) else len(rest.removesuffix(END.encode() * 2))
        return VERSION + END + head.decode(errors="replace"), rest[:end].decode(errors="replace"), lacks <= 0

    def run(batches):
        held, of = b"", None
        for batch in batches:
            out = []
            for file, value in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist()):
                if held and join and file == of and _parts(held)[2] > 0:
                    held += (VERSION + END).encode() + value
                else:
                    if held:
                        out.append(record_of(held))
                    held, of = value, file
                if not join and held:
                    out.append(record_of(held))
                    held = b""
            if out:
                yield _batch(out)
        if held:
            yield _batch([record_of(held)])

    def _batch(out):
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.string(), pa.string(), pa.bool_()))],
                                          names=["header", "block", "whole"])

    return run
