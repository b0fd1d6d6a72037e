"""WARC derivatives: metadata and plain-text conversion records of responses.

For each response record two records are made, linked to it by
``WARC-Refers-To``.  The metadata record holds ``application/warc-fields``: the
response's headers as they were, its payload digest, title, language and
outlinks.  The conversion record holds the page's plain text.  Ids are derived
from the source's id, so a rerun makes the same records; digests are SHA-256
over bytes and lengths count bytes.

Scale: column expressions over one scan, no shuffle.  ``write`` makes WARC
files with Spark's text writer, whose line separator is the end of a record.

Defined cases: null HTML is an empty payload, a null URL an empty target; rows
without an id are marked as such in the derived id; repeated rows give the
same records again.  An empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
#: Elements whose tags break lines, elements without text, and named entities: fixed values.
BLOCKS = ("address|article|aside|blockquote|br|dd|div|dl|dt|footer|form|h1|h2|h3|h4|h5|h6|header|hr|li|main|nav|ol|p|"
          "pre|section|table|td|th|title|tr|ul")
SILENT = "script|style|noscript|template"
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
            ("&copy;", "©"), ("&middot;", "·"), ("&hellip;", "…"), ("&mdash;", "—"),
            ("&ndash;", "–"), ("&amp;", "&")]
#: Patterns in the syntax that Java and RE2 share.
SILENT_RUN = rf"(?is)<(?:{SILENT})(?:[\x20\x09-\x0D/][^>]*)?>.*?</(?:{SILENT})[\x20\x09-\x0D]*>"
COMMENT = r"(?s)<!--.*?-->"
BLOCK_TAG = rf"(?i)</?(?:{BLOCKS})(?:[\x20\x09-\x0D/][^>]*)?>"
TAG = r"</?[A-Za-z!][^>]*>"
BLANKS, BREAKS = r"[\x20\x09\x0B-\x0D]+", r"\x20?\n[\x20\n]*"
TITLE, LANGUAGE = r"(?is)<title[^>]*>(.*?)</title", r'(?i)<html[^>]* lang="([^"]*)"'
LINK = r'(?i)<a[\x20\x09-\x0D][^>]*?href="([^"]*)"'


def plain_text(html: Column) -> Column:
    """Text of a page: silent elements and comments go, block tags become line breaks."""
    t = F.regexp_replace(F.regexp_replace(html, SILENT_RUN, " "), COMMENT, " ")
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"\n", " "), BLOCK_TAG, "\n"), TAG, "")
    for name, char in ENTITIES:
        t = F.replace(t, F.lit(name), F.lit(char))
    return F.btrim(F.regexp_replace(F.regexp_replace(t, BLANKS, " "), BREAKS, "\n"), F.lit(" \n"))


def _urn(seed: Column) -> Column:
    h = F.sha2(seed, 256)
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in
                                                           ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]))


def _digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of crawled pages: record_id, target_uri, date, headers and payload."""
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    seed = F.concat_ws("\n", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), url, F.sha2(html, 256))
    headers = F.concat(F.lit("HTTP/1.1 200 OK\nContent-Type: text/html; charset=utf-8\nContent-Length: "),
                       F.octet_length(html).cast("string"))
    return pages.select("page_id", _urn(seed).alias("record_id"), url.alias("target_uri"), F.lit(date).alias("date"),
                        headers.alias("headers"), html.alias("payload"))


def derivatives(records: DataFrame, carry: list[str]) -> DataFrame:
    """Metadata and conversion records of responses, with the columns ``carry``."""
    source_digest = _digest(F.col("payload"))
    title = F.regexp_replace(F.regexp_extract("payload", TITLE, 1), r"[\x20\x09-\x0D]+", " ")
    fields = F.concat_ws(
        CRLF,
        F.concat(F.lit("source-header: "), F.regexp_replace("headers", "\n", CRLF + "source-header: ")),
        F.concat(F.lit("source-payload-digest: "), source_digest),
        F.concat(F.lit("title: "), title),
        F.concat(F.lit("language: "), F.regexp_extract("payload", LANGUAGE, 1)),
        F.array_join(F.transform(F.regexp_extract_all("payload", F.lit(LINK), F.lit(1)),
                                 lambda x: F.concat(F.lit("outlink: "), x)), CRLF))
    made = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"),
                 F.concat(fields, F.lit(CRLF)).alias("content")),
        F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=utf-8").alias("content_type"),
                 plain_text(F.col("payload")).alias("content")))
    rows = records.select(*carry, F.col("record_id").alias("refers_to"), "target_uri", "date",
                          source_digest.alias("source_digest"), F.explode(made).alias("m"))
    return rows.select(*carry, "m.warc_type", _urn(F.concat_ws("\n", "m.warc_type", "refers_to")).alias("record_id"),
                       "refers_to", "target_uri", "date", "source_digest", _digest(F.col("m.content")).alias("block_digest"),
                       "m.content_type", F.octet_length("m.content").cast("long").alias("content_length"), "m.content")


def record_text(records: DataFrame) -> DataFrame:
    """One column ``value``: the whole record, without the two line ends behind it."""
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), "warc_type"),
             F.concat(F.lit("WARC-Record-ID: <"), F.col("record_id"), F.lit(">")),
             F.concat(F.lit("WARC-Date: "), "date"), F.concat(F.lit("WARC-Target-URI: "), "target_uri"),
             F.concat(F.lit("WARC-Refers-To: <"), F.col("refers_to"), F.lit(">")),
             F.concat(F.lit("WARC-Block-Digest: "), "block_digest"),
             F.concat(F.lit("WARC-Payload-Digest: "), "block_digest"),
             F.concat(F.lit("Content-Type: "), "content_type"),
             F.concat(F.lit("Content-Length: "), F.col("content_length").cast("string"))]
    return records.select(F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), "content").alias("value"))


def write(records: DataFrame, path: str, compression: str = "none") -> None:
    """WARC files of the records."""
    record_text(records).write.option("lineSep", CRLF * 2).option("compression", compression).text(path)
