import hashlib

import pytest
from pyspark.sql import functions as F

from kilnmark.llm import warc
from kilnmark.llm.common import fresh_path

FAKE = warc.MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
PAGES = [(1, "http://a/\r\nx", "x" * 1500), (2, None, "x" * 1500), (3, "u", FAKE * 3 + "tail"), (4, "u", None), (5, "u", ""),
         (6, "u", "short"), (7, "u", "short"), (8, "u", "é" * 700), (9, "u", "é" * 700 + warc.MAGIC), (None, "u", "x" * 1500),
         (10, "u", warc.MAGIC), (11, "u", "\r\n\r\n" + FAKE), (12, "u", FAKE + "y" * 3000)]


def expected(pages):
    best = {}
    for page, _, html in pages:
        if len((html or "").encode()) >= 1000 and page is not None:
            best[html] = max(best.get(html, page), page)
    for page, _, html in pages:
        data = (html or "").encode()
        target = best.get(html) if len(data) >= 1000 else None
        revisit = target is not None and target != page
        yield page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", target if revisit else None


@pytest.mark.parametrize("block", ["128m", "700b"])
def test_round_trip(spark, block):
    pages = spark.createDataFrame(PAGES * 1, "page_id long, url string, html string").withColumn("file", F.lit("clash"))
    path = fresh_path(spark, "warc-test")
    warc.write_archives(pages.coalesce(1), path)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = warc.read_archives(spark, path).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    rows = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(rows, key=key) == sorted(expected(PAGES), key=key)


def test_empty(spark):
    path = fresh_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_archives(spark, path).count() == 0


def test_repeated_rows_and_payload(spark):
    pages = spark.createDataFrame([(1, "u", "z" * 1200)] * 2 + [(0, "u", "z" * 1200)], "page_id long, url string, html string")
    path = fresh_path(spark, "warc-test")
    warc.write_archives(pages, path)
    got = sorted((r.page_id, r.record_type, r.refers_to, len(r.payload)) for r in
                 warc.read_archives(spark, path, keep_payload=True).collect())
    assert got == [(0, "revisit", 1, 0), (1, "response", None, 1200), (1, "response", None, 1200)]
