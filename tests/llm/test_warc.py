"""WARC response records: parsing, linked derivatives, ids that never collide, linear markup."""

import hashlib
import time

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc

N = "\r\n"


def record(kind="response", rid="<urn:uuid:1>", uri="http://a/b?c: d", date="2024-05-01T10:00:00Z", http="HTTP/1.1 200 OK", headers=("Content-Type: text/html", "X-Two: a: b"),
           payload="<p>text</p>", length=True, tail=N * 2):
    body = N.join([http, *headers]) + N * 2 + payload
    head = [f"WARC/1.1", f"WARC-Type: {kind}"] + [f"{k}: {v}" for k, v in (("WARC-Record-ID", rid), ("WARC-Target-URI", uri), ("WARC-Date", date)) if v]
    head += [f"Content-Length: {len(body.encode())}"] if length else []
    return N.join(head) + N * 2 + body + (tail if length else "")


def test_responses_are_parsed_from_records(spark):
    texts = [record(), record(kind="request"), record(rid="<urn:uuid:2>", payload="é\r\n\r\nzwei", http="HTTP/1.0 404 Not Found", date=None),
             record(rid="<urn:uuid:3>", length=False, payload="open end"), record(rid="<urn:uuid:4>", payload=""), None, "", "no record", "WARC/1.1\r\nwarc-type:RESPONSE\r\n\r\n"]
    df = spark.createDataFrame([(t, "clash") for t in texts], "record string, payload string")
    got = {r.record_id: r for r in warc.parse_responses(df).collect()}
    assert set(got) == {"<urn:uuid:1>", "<urn:uuid:2>", "<urn:uuid:3>", "<urn:uuid:4>", None}
    one = got["<urn:uuid:1>"]
    assert (one.target_uri, one.warc_date, one.status, one.payload) == ("http://a/b?c: d", "2024-05-01T10:00:00Z", 200, "<p>text</p>")
    assert one.headers == "Content-Type: text/html\r\nX-Two: a: b"
    assert (got["<urn:uuid:2>"].status, got["<urn:uuid:2>"].warc_date, got["<urn:uuid:2>"].payload) == (404, None, "é\r\n\r\nzwei")
    assert got["<urn:uuid:3>"].payload == "open end" and got["<urn:uuid:4>"].payload == ""
    assert warc.parse_responses(df.limit(0)).count() == 0


def test_derivatives_of_records_keep_headers_dates_and_links(spark):
    df = spark.createDataFrame([(record(),), (record(rid="<urn:uuid:2>", payload="<p>two &amp; more"),)], "record string")
    got = {(r.refers_to, r.warc_type): r for r in warc.derivatives(warc.parse_responses(df)).collect()}
    meta, conv = got["<urn:uuid:1>", "metadata"], got["<urn:uuid:1>", "conversion"]
    assert meta.warc_date == conv.warc_date == "2024-05-01T10:00:00Z" and conv.block == "text"
    fields = dict(x.split(": ", 1) for x in meta.block.strip().split(N))
    digest = "sha256:" + hashlib.sha256(b"<p>text</p>").hexdigest()
    assert fields["Content-Type"] == "text/html" and fields["X-Two"] == "a: b" and fields["source-status"] == "200"
    assert fields["source-digest"] == digest == conv.payload_digest and fields["source-length"] == "11"
    again = warc.parse_responses(warc.serialized(warc.derivatives(warc.parse_responses(df))))
    assert again.count() == 0  # derivatives are no responses


def test_two_captures_of_a_page_are_two_records(spark):
    rows = [(1, "http://a", "<p>old</p>"), (1, "http://a", "<p>new</p>"), (1, "x|y", ""), (1, "x", "|y"), (None, "1", "a"), (1, None, "a"), (1, "http://a", "<p>old</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    ids = [r.record_id for r in warc.responses(df).collect()]
    assert len(set(ids)) == 6 and ids[0] == ids[-1]
    got = warc.derivatives(warc.responses(df)).collect()
    assert len({r.record_id for r in got}) == 12 and {r.refers_to for r in got} == set(ids)
    key = spark.createDataFrame([("1|x", "y"), ("1", "x|y")], "page_id string, url string").withColumn("html", F.lit(""))
    assert len({r.record_id for r in warc.responses(key).collect()}) == 2


def test_dates_and_headers_of_a_page_table_are_kept(spark):
    df = spark.createDataFrame([(1, "u", "t", "2024-01-01", "A: b")], "page_id long, url string, html string, day string, head string")
    r = warc.derivatives(warc.responses(df, date_col="day", headers_col="head")).where("warc_type = 'metadata'").first()
    assert r.warc_date == "2024-01-01" and r.block.startswith("A: b\r\nsource-length: 1\r\n")
    assert warc.derivatives(warc.responses(df.limit(0))).count() == 0


@pytest.mark.parametrize("bad", ["<a href=", "<script", "<a href='", "<!--", "<!-- --", "<", "</", "<![CDATA["])
def test_hostile_markup_takes_linear_time(bad):
    t = time.process_time()
    warc.text_of("start " + bad * 60_000)
    assert time.process_time() - t < 4
