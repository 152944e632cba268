import gzip
import hashlib

import duckdb

from paperloom.llm import storage, warc


def brute(rows):
    out, keep = [], {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and page is not None:
            keep[data] = max(keep.get(data, page), page)
    for page, _, html in rows:
        data = (html or "").encode()
        k = keep.get(data)
        revisit = k is not None and page != k
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", k if revisit else None))
    return sorted(out, key=str)


def test_sql_agrees(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    got = warc.query(spark, sf).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    want = con.sql(f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM ({warc.ORACLE})").fetchall()
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)


def test_copies_nulls_and_selection(spark, frame):
    big, other = "é" * 600, "z" * 999
    rows = [(i, f"http://a/{i}?x=y z\r\n", big) for i in range(20)] + [(30, None, None), (31, "u", ""), (32, "u", other), (33, "u", other), (None, "n", big), (None, None, "y" * 2000), (19, "again", big)]
    pages = frame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS payload", "2 AS salt")
    path = storage.fresh_path(spark, "w")
    index = warc.write(pages, path)
    got = warc.read(index, path).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(rows)
    assert {r.url for r in got} == {u for _, u, _ in rows}
    some = warc.read(index.filter("page_id IN (3, 32, 19)"), path).collect()
    assert sorted(r.page_id for r in some) == [3, 19, 19, 32]
    assert next(bytes(r.payload) for r in some if r.page_id == 32) == other.encode()
    assert warc.write(frame([], "page_id long, url string, html string"), storage.fresh_path(spark, "w")).count() == 0


def test_files_are_plain_warc(spark, frame):
    path = storage.fresh_path(spark, "w")
    index = warc.write(frame([(1, "http://a", "hello")], "page_id long, url string, html string"), path).first()
    text = gzip.decompress(storage.read_all(f"{path}/{index.file}")).decode()
    assert text.startswith("WARC/1.1\r\nWARC-Type: response\r\n") and text.endswith("hello\r\n\r\n")


def test_near_records_share_a_range(spark, frame):
    rows = [("f", i * 100, 100, "u") for i in range(10)] + [("f", 10_000_000, 50, "u"), ("f", 10_200_000, 50, "u"), ("g", 0, 5, "u")]
    got = warc.ranges(frame(rows, "file string, offset long, length long, url string")).orderBy("file", "first").collect()
    assert [(r.file, r["first"], r["last"], len(r.records)) for r in got] == [("f", 0, 1000, 10), ("f", 10_000_000, 10_000_050, 1), ("f", 10_200_000, 10_200_050, 1), ("g", 0, 5, 1)]
