import base64
import gzip
import hashlib
import io

import pytest

from panelforge.llm import warc as W
from panelforge.session import scratch_path
from conftest import SF01


def brute(rows):
    first = {}
    for i, h in rows:
        h = h or ""
        first[h] = min(first.get(h, i), i)
    out = []
    for i, h in rows:
        data = (h or "").encode()
        again = first[h or ""] != i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", first[h or ""] if again else None))
    return sorted(out)


def test_query_equals_brute_force(spark):
    from __spark_entry__ import queries

    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF01}/pages.parquet").collect()]
    assert sorted(tuple(r) for r in queries()["op3_warc"](spark, SF01).collect()) == brute(rows)


PAGES = [(7, "http://a/?x=1", "<p>é</p>"), (3, None, "<p>é</p>"), (9, "http://b", None), (8, "u", ""), (1, "http://cé", "x" * 300000 + "\r\n\r\nWARC/1.1\r\n"), (5, "u", "\r\n\r\n"), (5, "u", "\r\n\r\n")]


@pytest.fixture(scope="module")
def folder(spark):
    path = scratch_path(spark, "warc-test")
    df = spark.createDataFrame([(*p, 1, "z") for p in PAGES], "page_id long, url string, html string, bytes int, payload string")
    W.write_pages(df, path)
    return path


def test_round_trip_of_odd_payloads(spark, folder):
    got = W.read(spark, folder)
    assert sorted(map(tuple, W.page_digests(got).collect())) == brute([(i, h) for i, _, h in PAGES])
    by = {r.record_id: r for r in got.collect()}
    assert bytes(by["<urn:page:1>"].payload).decode() == PAGES[4][2] and by["<urn:page:1>"].target_uri == "http://cé"
    assert by["<urn:page:3>"].target_uri is None and by["<urn:page:7>"].refers_to == "<urn:page:3>"
    assert by["<urn:page:7>"].headers["warc-profile"] == W.REVISIT_PROFILE and len(by["<urn:page:7>"].payload) == 0


def test_files_are_plain_gzip_members(spark, folder):
    fs, at = W.open_folder(folder)
    import pyarrow.fs as pafs

    text = b"".join(gzip.decompress(fs.open_input_file(i.path).read()) for i in fs.get_file_info(pafs.FileSelector(at)) if i.path.endswith(".gz"))
    assert text.count(b"WARC-Type: revisit") == 2 and text.count(b"WARC-Type: response") == 5


def test_pushdown_of_types_and_headers(spark, folder):
    df = W.read(spark, folder)
    revisits = df.where("record_type = 'revisit' and length(headers['warc-profile']) > 3").select("record_id")
    assert "revisit" not in revisits._jdf.queryExecution().executedPlan().toString().split("Filter")[-1].split("\n")[0]
    assert sorted(r[0] for r in revisits.collect()) == ["<urn:page:7>", "<urn:page:9>"]
    assert df.where("target_uri in ('u', 'http://b') and record_type = 'response'").count() == 3
    assert df.where("target_uri is null").count() == 1
    assert {r.record_type for r in W.read(spark, folder, types="response").collect()} == {"response"}
    assert all(r.payload is None for r in W.read(spark, folder, payload=False).collect())


def test_unwanted_payloads_are_not_inflated():
    data = b"".join(W.member([("WARC-Type", t)], b"y" * n) for t, n in (("response", 10**6), ("revisit", 0), ("response", 5)))
    reads = []

    class Spy(io.BytesIO):
        def size(self):
            return len(self.getbuffer())

        def read(self, n=-1):
            out = super().read(n)
            reads.append(len(out))
            return out

    out = list(W.records(Spy(data), lambda h: h["warc-type"] == "revisit", True))
    assert [(h["warc-type"], p) for _, h, p in out] == [("revisit", b"")] and len(reads) == 3


def test_foreign_archives_without_the_extra_field():
    head = "WARC/1.0\r\nWARC-Type: {}\r\nX-Long: a\r\n b\r\nContent-Length: {}\r\n\r\n"
    data = b"".join(gzip.compress(head.format(t, len(b)).encode() + b + b"\r\n\r\n") for t, b in (("warcinfo", b"i" * 9), ("response", b"r" * 70000), ("request", b"")))

    class File(io.BytesIO):
        def size(self):
            return len(self.getbuffer())

    got = [(h["warc-type"], h["x-long"], len(p)) for _, h, p in W.records(File(data), lambda h: True, True)]
    assert got == [("warcinfo", "a b", 9), ("response", "a b", 70000), ("request", "a b", 0)]
    assert [h["warc-type"] for _, h, _ in W.records(File(data), lambda h: h["warc-type"] == "request", True)] == ["request"]


def test_min_bytes_and_empty_table(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    kinds = {(r.record_id, r.record_type) for r in W.page_records(df, min_bytes=5).collect()}
    assert ("<urn:page:9>", "response") in kinds and ("<urn:page:7>", "revisit") in kinds
    path = scratch_path(spark, "warc-empty")
    W.write_pages(df.limit(0), path)
    assert W.read(spark, path).collect() == []


def test_null_id_beside_an_equal_payload_keeps_its_bytes(spark):
    df = spark.createDataFrame([(1, "u", "<p>same</p>"), (2, "v", "<p>same</p>"), (None, "w", "<p>same</p>")], "page_id long, url string, html string")
    got = {r.target_uri: (r.record_type, bytes(r.payload) if r.payload is not None else None) for r in W.page_records(df).collect()}
    assert got == {"u": ("response", b"<p>same</p>"), "v": ("revisit", None), "w": ("response", b"<p>same</p>")}


def test_urls_with_line_breaks_stay_one_header():
    urls = ["u\r\nWARC-Type: revisit", "u\r\n\r\nbody", "u\n x\x7f\0", "é \u2028 %0D"]
    data = b"".join(W.member([("WARC-Type", "response"), ("WARC-Target-URI", u)], b"payload") for u in urls)

    class File(io.BytesIO):
        def size(self):
            return len(self.getbuffer())

    got = [(h["warc-type"], h["warc-target-uri"], p) for _, h, p in W.records(File(data), lambda h: True, True)]
    assert got == [("response", u, b"payload") for u in ("u%0D%0AWARC-Type: revisit", "u%0D%0A%0D%0Abody", "u%0A x%7F%00", "é \u2028 %0D")]
