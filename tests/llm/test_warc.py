import hashlib

from pyspark.sql import functions as F

from strata.llm import warc
from strata.sources.checkpoint import table_dir

BIG = "<p>" + "word " * 300
PAGES = [(1, "https://a.example/x?y=1#f", BIG), (2, "http://b.example", BIG), (5, None, BIG), (3, "https://c.example/\r\nWARC/1.1\r\n", "small"), (4, "u", "small"),
         (6, "https://d.example/", None), (7, "https://e.example/", ""), (8, "https://f.example/", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" + "é" * 600 + "WARC/1.1\r\nWARC/1.1\r\n"),
         (9, "https://g.example/", "a\r\n\r\n\r\n\r\nb" + "\r\n" * 700), (None, "https://h.example/", BIG), (None, None, None), (10, "i", "twice " * 300), (10, "i", "twice " * 300),
         (11, "j", "x" * 300_000)]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "old") for r in rows], "page_id long, url string, html string, payload_digest string")


def test_round_trip(spark):
    path = table_dir(spark)
    warc.write_archive(pages(spark), path)
    got = sorted(map(str, warc.page_records(spark, path).collect()))
    largest = {}
    for i, _, html in PAGES:
        if len((html or "").encode()) >= 1000 and i is not None:
            largest[html] = max(i, largest.get(html, i))
    want = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        to = largest.get(html) if len(data) >= 1000 else None
        again = to is not None and (i is None or i < to)
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", to if again else None))
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert got == sorted("Row(" + ", ".join(f"{n}={v!r}" for n, v in zip(names, w)) + ")" for w in want)


def test_captures_are_nested(spark):
    path = table_dir(spark)
    warc.write_archive(pages(spark), path)
    rows = {r["metadata"]["page_id"]: r for r in warc.captures(warc.read_records(spark, path)).collect()}
    assert rows[1]["request"].asDict() == {"method": "GET", "path": "/x?y=1", "host": "a.example"}
    assert rows[1]["response"]["payload"] is None and rows[1]["response"]["refers_to"] == rows[5]["capture_id"]
    assert rows[5]["response"]["payload"].decode() == BIG and rows[5]["response"]["status"] == 200
    assert rows[8]["response"]["payload"].decode() == PAGES[7][2]
    assert rows[3]["url"] == "https://c.example/%0D%0AWARC/1.1%0D%0A"


def test_short_record_is_an_error(spark):
    path = table_dir(spark)
    text = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 50\r\n\r\nshort"
    spark.createDataFrame([(text,)], "value string").write.text(path, lineSep="\r\n\r\n")
    try:
        warc.read_records(spark, path).select(F.sha1("block")).collect()
        raise AssertionError("read a short record")
    except Exception as e:
        assert "shorter than its Content-Length" in str(e)


def test_empty(spark):
    path = table_dir(spark)
    warc.write_archive(pages(spark, []), path)
    assert warc.page_records(spark, path).collect() == []
