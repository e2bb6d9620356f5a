"""WARC derivatives: response, metadata and conversion records of web pages, linked and with digests.

A page becomes a response record. Its metadata record holds facts about the page (title, language, links) as
warc-fields, its conversion record the plain text. Both name the response in WARC-Refers-To, with its target
URI and date, and keep its payload digest in the extension field X-Source-Payload-Digest. Record ids are
name-based UUIDs of page, URL, kind, content and the row's place in the input, so repeated rows have records of
their own, and a second run over the same files or another attempt makes the same ones.

Markup goes by expressions that run to the end of the page where a tag, a comment, a script or a style is not
closed, so their time is in proportion to the page. Character references are decoded by Python's table of
them, in Arrow batches; everything else is DataFrame functions.

Cases: a null page body is an empty one; a null URL leaves the target URI out; a null id is written as an
empty one; line ends and tabs of a URL, a link or a language are percent-encoded in headers and fields and other
control characters dropped, so no value can begin a line; an empty table gives no records; other columns are not looked at.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

CRLF = "\r\n"
HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"
# Elements that end a line of text.
BLOCKS = "address|article|aside|blockquote|br|dd|div|dl|dt|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul"


def base32_sha1(value: Column) -> Column:
    """`sha1:` and the digest in base 32, as digests of records are written."""
    digest = F.sha1(value)
    fives = [
        F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    letters = F.translate(F.concat(*fives), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    return F.concat(F.lit("sha1:"), letters)


def record_id(*parts: Column) -> Column:
    """`<urn:uuid:...>` with a name-based UUID of the parts."""
    # The length of each part keeps parts apart, whatever characters they have.
    digest = F.sha1(F.concat(*[F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]))
    at = lambda start, size: F.substring(digest, start, size)
    uuid = F.concat_ws(
        "-", at(1, 8), at(9, 4), F.concat(F.lit("5"), at(14, 3)), F.concat(F.lit("8"), at(18, 3)), at(21, 12)
    )
    return F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">"))


# Up to the end of the page, where what is begun does not end.
IN_TAG = r"[^>]*+(?:>|\z)"
HIDDEN = rf"(?is)<!--.*?(?:-->|\z)|<(script|style)\b{IN_TAG}.*?(?:</\1\b{IN_TAG}|\z)"


def without_markup(page: Column) -> Column:
    """A page without scripts, styles, comments and tags; those of blocks end a line."""
    text = F.regexp_replace(page, HIDDEN, " ")
    text = F.regexp_replace(text, rf"(?i)</?(?:{BLOCKS})\b{IN_TAG}", "\n")
    return F.regexp_replace(text, rf"<[/!a-zA-Z]{IN_TAG}", "")


def tidied(text: Column) -> Column:
    """White space put in order: no-break spaces are spaces, runs of spaces one, and runs with a line end a line end."""
    text = F.regexp_replace(text, "[ \t\r\f\u00a0]+", " ")
    return F.trim(F.regexp_replace(text, r" ?\n[ \n]*", "\n"), F.lit(" \n"))


REFERENCE = re.compile(r"&#?\w")


@F.pandas_udf(T.StringType())
def decoded(texts: pd.Series) -> pd.Series:
    """Texts with their character references decoded, named and numbered ones."""
    return texts.map(lambda t: html.unescape(t) if t and REFERENCE.search(t) else t)


def safe(value: Column) -> Column:
    """A value that cannot begin a line: line ends and tabs percent-encoded, other control characters dropped."""
    out = value
    for code in (9, 10, 13):
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.regexp_replace(out, r"[\x00-\x1f\x7f]+", "")


def _record(kind: str, own_id: Column, refers_to: Column, content_type: str, block: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("record_type"), own_id.alias("record_id"), refers_to.alias("refers_to"),
        F.lit(content_type).alias("content_type"), block.alias("block"),
    )


def build_derivatives(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Three records of every page: (id, record_type, record_id, refers_to, target_uri, content_type,
    content_length, block_digest, payload_digest, source_digest, source_headers, headers, block)."""
    page = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("uri"), F.coalesce(F.col(html_col), F.lit("")).alias("html"),
        safe(F.col(url_col)).alias("safe_uri"),
    )
    page = page.select(
        "*",
        base32_sha1(F.col("html")).alias("source_digest"),
        F.concat(F.lit(HTTP_HEAD), F.lit("Content-Length: "), F.octet_length("html").cast("string"), F.lit(CRLF)).alias(
            "source_headers"
        ),
    )
    name = [F.coalesce(F.col("id").cast("string"), F.lit("")), F.coalesce("uri", F.lit("")), F.col("source_digest")]
    place = F.monotonically_increasing_id().cast("string")
    page = page.withColumns({"place": place, "text": decoded(without_markup(F.col("html")))})
    name.append(F.col("place"))
    page = page.withColumn("response_id", record_id(F.lit("response"), *name))
    title = F.trim(F.regexp_extract("html", rf"(?is)<title\b{IN_TAG}(.*?)(?:</title|\z)", 1))
    anchors = F.regexp_extract_all("html", F.lit(rf"(?i)<a\s{IN_TAG}"), F.lit(0))
    links = F.transform(anchors, lambda a: F.regexp_extract(a, r"(?i)\shref=\"([^\"]*+)\"", 1))
    links = F.filter(links, lambda x: x != "")
    language = F.regexp_extract(F.regexp_extract("html", rf"(?i)<html\b{IN_TAG}", 0), r"(?i)\slang=\"([^\"]*+)\"", 1)
    fields = F.concat(
        F.lit("title: "), safe(F.regexp_replace(title, r"\s+", " ")), F.lit(CRLF),
        F.lit("language: "), safe(language), F.lit(CRLF),
        F.array_join(F.transform(links, lambda x: F.concat(F.lit("outlink: "), safe(x), F.lit(CRLF))), ""),
    )
    response = F.concat("source_headers", F.lit(CRLF), "html")
    derived = F.col("response_id")
    kinds = F.array(
        _record("response", derived, F.lit(None).cast("string"), "application/http; msgtype=response", response),
        _record("metadata", record_id(F.lit("metadata"), *name), derived, "application/warc-fields", fields),
        _record(
            "conversion", record_id(F.lit("conversion"), *name), derived, "text/plain; charset=utf-8",
            tidied(F.col("text")),
        ),
    )
    records = page.select("id", "uri", "safe_uri", "source_digest", "source_headers", F.inline(kinds)).select(
        "*",
        F.octet_length("block").cast("long").alias("content_length"),
        base32_sha1(F.col("block")).alias("block_digest"),
    )
    # The payload of a response is the page without the headers, that of the others the whole block.
    records = records.withColumn(
        "payload_digest", F.when(F.col("record_type") == "response", F.col("source_digest")).otherwise(F.col("block_digest"))
    )
    derivative = F.col("refers_to").isNotNull()
    line = lambda label, value: F.coalesce(F.concat(F.lit(f"{label}: "), value, F.lit(CRLF)), F.lit(""))
    headers = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("safe_uri")),
        line("WARC-Refers-To", F.col("refers_to")),
        line("WARC-Refers-To-Target-URI", F.when(derivative, F.col("safe_uri"))),
        line("WARC-Refers-To-Date", F.when(derivative, F.lit(date))),
        line("X-Source-Payload-Digest", F.when(derivative, F.col("source_digest"))),
        line("WARC-Block-Digest", F.col("block_digest")),
        line("WARC-Payload-Digest", F.col("payload_digest")),
        line("Content-Type", F.col("content_type")),
        line("Content-Length", F.col("content_length").cast("string")),
    )
    return records.select(
        F.col("id").alias(id_col), "record_type", "record_id", "refers_to", F.col("uri").alias("target_uri"), "content_type",
        "content_length", "block_digest", "payload_digest", "source_digest", "source_headers", headers.alias("headers"), "block",
    )


def write_warc(records: DataFrame, path: str) -> None:
    """Write records as uncompressed WARC files, one for each partition."""
    whole = F.concat("headers", F.lit(CRLF), "block", F.lit(CRLF))  # the line separator is the second one
    records.select(whole.alias("value")).write.option("lineSep", CRLF).option("compression", "none").text(path)
