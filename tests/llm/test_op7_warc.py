"""WARC: records by hand, the archives on disk, and the round trip against plain Python."""

import glob
import gzip
import hashlib
import io
from collections import Counter

import pytest

from tidepool.llm import warc
from tidepool.llm.registry import op7_digest

LONG = "<html>" + "é" * 100 + "</html>"
TRICKY = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" + "\x00z" * 60
ROWS = [(5, "http://a.example/x?y=1", LONG), (3, "http://b.example/", LONG), (9, "http://c.example", LONG), (1, "http://d.example/1", "short"),
        (2, "http://e.example/1", "short"), (4, None, None), (6, "u", ""), (7, "http://f.example\nX: y", TRICKY), (8, "v", "z" * 3_000_000), (10, "w", TRICKY)]


def expected(rows):
    digest = lambda h: hashlib.sha256((h or "").encode()).hexdigest()
    first = {}
    for p, _, h in rows:
        if p is not None and len((h or "").encode()) >= 100:
            first[digest(h)] = min(p, first.get(digest(h), p))
    out = []
    for p, _, h in rows:
        f = first.get(digest(h))
        again = f is not None and p != f
        out.append((p, len((h or "").encode()), digest(h), "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


def test_record_and_parser():
    data = gzip.decompress(warc.record([("WARC-Type", "x"), ("A", "b\r\nc")], b"WARC/1.1\r\n\r\n") + warc.EMPTY_MEMBER + warc.record([("WARC-Type", "y")], b""))
    assert list(warc.parse(io.BytesIO(data))) == [
        ({"warc-type": "x", "a": "b c", "content-length": "12"}, b"WARC/1.1\r\n\r\n"), ({"warc-type": "y", "content-length": "0"}, b"")]
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(data[:-8][:60])))


def test_archives_and_captures(spark, tmp_dir):
    pages = spark.createDataFrame([(*r, 1) for r in ROWS], "page_id long, url string, html string, record_type int").repartition(3)
    path = f"{tmp_dir}/w"
    warc.write_pages(pages, path, file_bytes=1 << 20)
    files = glob.glob(f"{path}/part-*")
    assert len(files) >= 2  # maxRecordsPerFile
    records = [r for f in files for r in warc.parse(gzip.open(f))]
    assert Counter(h["warc-type"] for h, _ in records) == {"request": 10, "metadata": 10, "response": 7, "revisit": 3}
    assert len({h["warc-record-id"] for h, _ in records}) == 30
    got = warc.page_captures(spark, path)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "requests", "response", "metadata"]
    rows = got.collect()
    assert sorted([tuple(r[:5]) for r in rows], key=str) == expected(ROWS)
    for r in rows:
        assert [x.concurrent_to for x in (*r.requests, *r.metadata)] == [[r.response.record_id]] * 2
        assert r.requests[0].head.startswith("GET /")
        html = dict((p, h) for p, _, h in ROWS)[r.page_id]
        assert bytes(r.response.payload) == (b"" if r.record_type == "revisit" else (html or "").encode())


def archive(path, records):
    """A plain archive of (type, id, ids it is concurrent to)."""
    with open(path, "wb") as f:
        for kind, rid, to in records:
            headers = [("WARC-Type", kind), *([("WARC-Record-ID", rid)] if rid else []), *[("WARC-Concurrent-To", t) for t in to]]
            f.write(gzip.decompress(warc.record(headers, b"x")))


def shape(rows):
    ids = lambda records: [r.record_id for r in records]
    return {r.capture_id: (r.response and r.response.record_id, ids(r.requests), ids(r.metadata), ids(r.others)) for r in rows}


def test_one_row_per_capture(spark, tmp_dir):
    archive(f"{tmp_dir}/part-plain.warc", [
        ("warcinfo", "<info>", []), ("response", "<r1>", []), ("request", "<q1>", ["<r1>"]), ("request", "<q2>", ["<r1>"]), ("metadata", "<m1>", ["<r1>"]),
        ("metadata", "<m2>", ["<r1>", "<r2>"]), ("revisit", "<r2>", []), ("request", "<q0>", ["<r0>"]), ("metadata", "<alone>", []), ("response", "<r3>", ["<q3>", "<m3>"]),
        ("request", "<q3>", []), ("metadata", "<m3>", []), ("response", "<r4>", []), ("response", "<r4>", []), ("resource", "<x>", ["<r4>"]), ("request", None, [])])
    rows = warc.captures(warc.read_records(spark, tmp_dir)).collect()
    assert len(rows) == 8 and shape(rows) == {
        "<info>": (None, [], [], ["<info>"]), "<r1>": ("<r1>", ["<q1>", "<q2>"], ["<m1>", "<m2>"], []), "<r2>": ("<r2>", [], ["<m2>"], []),
        "<r0>": (None, ["<q0>"], [], []), "<alone>": (None, [], ["<alone>"], []), "<r3>": ("<r3>", ["<q3>"], ["<m3>"], []),
        "<r4>": ("<r4>", [], [], ["<x>", "<r4>"]), None: (None, [None], [], [])}


def test_names_of_archives(spark, tmp_dir):
    archive(f"{tmp_dir}/CRAWL-2024-00001.warc", [("response", "<a>", [])])
    with gzip.open(f"{tmp_dir}/other.warc.gz", "wb") as f:
        f.write(gzip.decompress(warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<b>")], b"x")))
    ids = lambda **how: {r.record_id for r in warc.read_records(spark, tmp_dir, **how).collect()}
    assert ids() == {"<a>", "<b>"} and ids(glob="*.warc.gz") == {"<b>"} and ids(glob="CRAWL*") == {"<a>"}


def test_files_are_cut_by_bytes(spark, tmp_dir):
    """Large pages that lie together among small ones: no file much beyond the bytes wanted, but for one page's own."""
    import os
    import random
    rng = random.Random(3)
    noise = lambda n: rng.randbytes(n // 2).hex()
    rows = [(i, f"u{i}", noise(300)) for i in range(300)] + [(1000 + i, f"v{i}", noise(400_000)) for i in range(20)] + [(2000, "big", noise(6_000_000))] + [(3000 + i, f"w{i}", noise(300)) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_pages(pages, f"{tmp_dir}/w", file_bytes=1 << 20)
    sizes = sorted(os.path.getsize(f) for f in glob.glob(f"{tmp_dir}/w/part-*"))
    assert len(sizes) >= 6 and sizes[-2] < 1.5 * (1 << 20) and sizes[-1] < 5_000_000
    got = warc.page_captures(spark, f"{tmp_dir}/w").select("page_id", "payload_bytes").collect()
    assert sorted(map(tuple, got)) == sorted((p, len(h)) for p, _, h in rows)


def test_ties_nulls_and_empty_tables(spark):
    schema = "page_id long, url string, html string"
    rows = [(3, "a", LONG), (3, "a", LONG), (3, "b", LONG), (4, "c", LONG), (None, "d", LONG), (None, "e", None)]
    got = sorted([(r.page_id, r.record_type, r.refers_to) for r in op7_digest(spark.createDataFrame(rows, schema)).collect()], key=str)
    assert got == sorted([(3, "response", None)] * 3 + [(4, "revisit", 3), (None, "revisit", 3), (None, "response", None)], key=str)
    assert op7_digest(spark.createDataFrame([], schema)).collect() == []
