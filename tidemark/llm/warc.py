"""WARC derivatives: metadata and conversion records linked to their responses.

Input is a table of response records, made of a page table (``responses``) or parsed from
the records of WARC files (``parse_responses``). Each response gives two records that refer
to it by its record id: a ``metadata`` record (application/warc-fields) that
carries the source headers, and a ``conversion`` record (text/plain) whose block is
the payload's text. Both keep the target URI and date of the response; the
conversion also keeps the payload digest of its source. All of it is row by row, without a
shuffle: DataFrame expressions, and one Arrow function for the payload's text.

Record ids are name-based: the first 16 bytes of the SHA-256 of record type and
source record id (for responses of a page table: key, URI, date and payload digest),
written as a UUID, so reruns give the same ids and the links hold.

Text of a payload: scripts, styles, comments and tags become a space each, character
references (named, decimal, hexadecimal) are decoded once, and white space, no-break
spaces among it, is folded. What is a tag: see ``markup``, which reads a page once.

Defined results: a null or empty payload gives an empty block (its digest is that
of the empty string); null headers, URI or date leave their fields out; repeated
responses give repeated derivatives; no rows give no rows.
"""

from __future__ import annotations

import html as _html
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .markup import closing, markup

CRLF = "\r\n"
RAW = closing("script", "style")
SPACES = re.compile("[ \t\r\n\x0b\x0c\xa0]+")


def sha256_label(c: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(c, 256))


def record_id(*parts: Column) -> Column:
    """A name-based id; each part goes in with its length, so parts never run together."""
    h = F.sha2(F.concat(*[F.concat(F.octet_length(p).cast("string"), F.lit(":"), p) for p in parts]), 256)
    at = lambda i, n: F.substring(h, i, n)
    return F.concat(F.lit("<urn:uuid:"), at(1, 8), F.lit("-"), at(9, 4), F.lit("-"), at(13, 4), F.lit("-"), at(17, 4), F.lit("-"), at(21, 12), F.lit(">"))


def text_of(page: str | None) -> str:
    """Text of a page: scripts, styles, comments and tags out, references decoded, white space folded."""
    parts = [part if kind == "text" else " " for kind, part, _ in markup(page or "", RAW)]
    return SPACES.sub(" ", _html.unescape("".join(parts))).strip(" ")


def plain_text(html: Column) -> Column:
    """``text_of`` of a column."""
    return F.arrow_udf(_texts, "string")(html)


def _texts(pages: pa.Array) -> pa.Array:
    return pa.array([text_of(p.as_py()) for p in pages], pa.string())


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date_col: str | None = None, headers_col: str | None = None) -> DataFrame:
    """Response records of a page table: source_key, record_id, target_uri, warc_date,
    status, headers, payload. The record id names key, URI, date and payload, so two
    captures of a page are two records; a table without dates or headers gives null."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    text = lambda c: F.col(c).cast("string") if c else F.lit(None).cast("string")
    payload, date = F.coalesce(F.col(html_col).cast("string"), F.lit("")), text(date_col)
    return pages.select(
        F.col(id_col).alias("source_key"),
        record_id(F.lit("response"), key, F.coalesce(F.col(url_col), F.lit("")), F.coalesce(date, F.lit("")), F.sha2(payload, 256)).alias("record_id"),
        F.col(url_col).alias("target_uri"), date.alias("warc_date"), F.lit(None).cast("int").alias("status"),
        text(headers_col).alias("headers"), payload.alias("payload"))


def parse_responses(records: DataFrame, record_col: str = "record") -> DataFrame:
    """As ``responses``, from the text of whole WARC records: the record's header names id,
    URI and date, the HTTP part status line, headers and payload (cut at Content-Length if
    the record has one, so the two line ends behind it are no payload). Records of other
    types, and null ones, are left out. ``source_key`` is the record id."""
    rec = F.col("__rec")
    split_at = lambda c: F.instr(c, CRLF * 2)
    part = lambda c, start, n=None: F.substr(c, start, n) if n is not None else F.substr(c, start)
    field = lambda c, name: F.nullif(F.regexp_extract(c, rf"(?im)^{name}[ \t]*:[ \t]*([^\r\n]*?)[ \t]*\r?$", 1), F.lit(""))
    r = records.where(F.col(record_col).isNotNull()).select(F.col(record_col).cast("string").alias("__rec"))
    at = split_at(rec)
    r = r.select(F.when(at > 0, part(rec, F.lit(1), at - 1)).otherwise(rec).alias("__head"), F.when(at > 0, part(rec, at + 4)).otherwise(F.lit("")).alias("__body"))
    r = r.where(F.lower(field(F.col("__head"), "WARC-Type")) == "response")
    size = field(F.col("__head"), "Content-Length").try_cast("int")
    raw = F.encode("__body", "UTF-8")
    body = F.when(size.isNotNull() & (size < F.octet_length("__body")), F.decode(F.substr(raw, F.lit(1), size), "UTF-8")).otherwise(F.col("__body"))
    r = r.select("__head", body.alias("__body"))
    b = split_at(F.col("__body"))
    r = r.select("__head", F.when(b > 0, part(F.col("__body"), F.lit(1), b - 1)).otherwise(F.col("__body")).alias("__http"),
                 F.when(b > 0, part(F.col("__body"), b + 4)).otherwise(F.lit("")).alias("payload"))
    head, http = F.col("__head"), F.col("__http")
    line = F.instr(http, CRLF)
    return r.select(
        field(head, "WARC-Record-ID").alias("source_key"), field(head, "WARC-Record-ID").alias("record_id"), field(head, "WARC-Target-URI").alias("target_uri"),
        field(head, "WARC-Date").alias("warc_date"), F.regexp_extract(http, r"^HTTP/\S+ +(\d{3})", 1).try_cast("int").alias("status"),
        F.when(line > 0, part(http, line + 2)).alias("headers"), "payload")


def derivatives(resp: DataFrame) -> DataFrame:
    """Two records per response: source_key, warc_type, record_id, refers_to,
    target_uri, warc_date, content_type, block, content_length, block_digest,
    payload_digest (of the source's payload). The metadata block has the source's
    HTTP headers, status, length and digest, and the digest of the text."""
    src = F.col("record_id")
    digest = sha256_label(F.col("payload"))
    field = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(name + ": "), c.cast("string"), F.lit(CRLF))).otherwise(F.lit(""))
    meta = F.concat(
        F.when(F.col("headers").isNotNull(), F.concat(F.col("headers"), F.lit(CRLF))).otherwise(F.lit("")),
        field("source-status", F.col("status")), field("source-length", F.octet_length("payload")), field("source-digest", digest), field("text-digest", sha256_label(F.col("__text"))))
    one = lambda kind, ctype, block: F.struct(
        F.lit(kind).alias("warc_type"), record_id(F.lit(kind), src).alias("record_id"), F.lit(ctype).alias("content_type"), block.alias("block"))
    both = resp.withColumn("__text", plain_text(F.col("payload"))).withColumn("__digest", digest)
    both = both.withColumn("__rec", F.explode(F.array(
        one("metadata", "application/warc-fields", meta), one("conversion", "text/plain; charset=utf-8", F.col("__text")))))
    block = F.col("__rec.block")
    return both.select(
        "source_key", "__rec.warc_type", F.col("__rec.record_id").alias("record_id"), src.alias("refers_to"),
        "target_uri", "warc_date", "__rec.content_type", block.alias("block"), F.octet_length(block).cast("long").alias("content_length"),
        sha256_label(block).alias("block_digest"), F.col("__digest").alias("payload_digest"))


def serialized(records: DataFrame) -> DataFrame:
    """Records as they stand in a WARC file: one string column ``record`` per row,
    for a text writer with an empty line separator."""
    line = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(name + ": "), c.cast("string"), F.lit(CRLF))).otherwise(F.lit(""))
    c = F.col
    return records.select(F.concat(
        F.lit("WARC/1.1" + CRLF), line("WARC-Type", c("warc_type")), line("WARC-Record-ID", c("record_id")),
        line("WARC-Refers-To", c("refers_to")), line("WARC-Target-URI", c("target_uri")), line("WARC-Date", c("warc_date")),
        line("WARC-Block-Digest", c("block_digest")), line("WARC-Payload-Digest", c("payload_digest")),
        line("Content-Type", c("content_type")), line("Content-Length", c("content_length")), F.lit(CRLF), c("block"), F.lit(CRLF * 2)).alias("record"))
