import base64
import gzip
import hashlib
import random

import pytest

from brook.llm import warc
from brook.session import scratch_path

PAGES = "page_id long, url string, html string, record string, digest string"


def pages(spark):
    rows = [(1, "http://a/\r\nx y", "same é", "x", "y"), (2, "http://b", "same é", "x", "y"), (3, None, None, "x", "y"), (4, "http://c", "", "x", "y"), (None, "http://d", "same é", "x", "y")]
    rows += [(7, "http://e", "WARC/1.0\r\n\r\nContent-Length: 5\r\n\r\n", "x", "y"), (8, "http://f", "long " * 100_000, "x", "y"), (9, "http://g", "twice", "x", "y"), (9, "http://g", "twice", "x", "y")]
    return rows, spark.createDataFrame(rows, PAGES).repartition(3)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def archived(spark, df, **how):
    whole = warc.write_archives(df, scratch_path(spark, "t-whole"), **how)
    return whole, warc.normalise(spark, whole, scratch_path(spark, "t-warc"))


def test_round_trip(spark):
    rows, df = pages(spark)
    _, path = archived(spark, df)
    got = warc.read_archives(spark, path).collect()
    have = sorted(((r["page_id"] or 0, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"] or 0) for r in got))
    first = {1: 2, 3: 4, None: 2}
    want = sorted((k or 0, len((h or "").encode()), digest(h), "revisit" if k in first else "response", first.get(k, 0)) for k, _, h, *_ in rows)
    assert have == want


def test_members_offsets_and_payloads(spark):
    rows, df = pages(spark)
    whole, path = archived(spark, df)
    files = {r["archive"]: bytes(r["content"]) for r in warc.archive_files(spark, path, "warc").collect()}
    found = {}
    for r in warc.read_index(spark, path).collect():
        record = gzip.decompress(files[r["archive"]][r["offset"] : r["offset"] + r["length"]])  # one member, one record
        assert record.startswith(b"WARC/1.0\r\n") and record.endswith(b"\r\n\r\n")
        found[r["record_id"]] = record
    html = {k: h for k, _, h, *_ in rows}
    assert found["<urn:page:7>"].split(b"\r\n\r\n", 2)[2] == html[7].encode() + b"\r\n\r\n"
    streams = sorted(gzip.decompress(bytes(r["content"])) for r in warc._binary_files(spark, whole, "*.gz").collect())
    assert sorted(map(gzip.decompress, files.values())) == [s for s in streams if s]  # the same bytes, whole file by whole file


def test_small_pieces_feed_alike():
    one = b"WARC/1.0\r\nContent-Length: 5\r\n\r\nab\r\n\r\r\n\r\n"
    reader = warc.Reader()
    got = [block for k in range(len(one) * 2) for _, _, block in reader.feed((one * 2)[k : k + 1])]
    assert got == [b"ab\r\n\r"] * 2 and not reader.rest


def test_min_bytes_and_empty_table(spark):
    _, df = pages(spark)
    _, path = archived(spark, df, min_bytes=1)
    kinds = {r["page_id"]: r["record_type"] for r in warc.read_archives(spark, path).collect()}
    assert kinds[3] == kinds[4] == "response" and kinds[1] == "revisit"
    _, path = archived(spark, spark.createDataFrame([], PAGES))
    assert warc.read_archives(spark, path).count() == 0


def test_a_record_without_its_index_line_is_an_error(spark, monkeypatch):
    _, df = pages(spark)
    _, path = archived(spark, df)
    index = warc.read_index(spark, path)
    monkeypatch.setattr(warc, "read_index", lambda *_: index.filter("record_id <> '<urn:page:7>'"))
    with pytest.raises(Exception, match="no index line"):
        warc.read_archives(spark, path).select("page_id").collect()


def test_archives_bounded_by_bytes_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(warc, "RECORD_BYTES", 1 << 10)
    rng = random.Random(3)
    sizes = [*[200] * 150, *[5_000] * 30, *[40_000] * 12, 300_000, 1_200_000]
    rng.shuffle(sizes)
    rows = [(k, f"http://h/{k}", "".join(rng.choices("abcdefgh", k=n)), "x", "y") for k, n in enumerate(sizes)]
    whole = warc.write_archives(spark.createDataFrame(rows, PAGES).coalesce(2), scratch_path(spark, "t-whole"), records_per_file=64)
    streams = [gzip.decompress(bytes(r["content"])) for r in warc._binary_files(spark, whole, "*.gz").collect()]
    assert all(len(x) <= 64 << 10 or x.count(b"WARC/1.0\r\n") == 1 for x in streams)
    assert sum(x.count(b"WARC/1.0\r\n") for x in streams) == len(rows)
    digests = sorted((k, digest(h)) for k, _, h, *_ in rows)
    path = warc.normalise(spark, whole, scratch_path(spark, "t-warc"))
    assert sorted((r["page_id"], r["payload_digest"]) for r in warc.read_archives(spark, path).collect()) == digests


def test_chunks_keep_order_and_offsets(spark):
    rng = random.Random(5)
    rows = [(k, f"http://h/{k}", "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=1 << 15)), "x", "y") for k in range(700)]
    df = spark.createDataFrame(rows, PAGES).coalesce(1)
    whole = warc.write_archives(df, scratch_path(spark, "t-whole"), records_per_file=8000)
    path = warc.normalise(spark, whole, scratch_path(spark, "t-warc"))
    files = {r["archive"]: bytes(r["content"]) for r in warc.archive_files(spark, path, "warc").collect()}
    index = warc.read_index(spark, path).collect()
    assert len(index) == len(rows) and max(map(len, files.values())) > warc.CHUNK
    html = {f"<urn:page:{k}>": h.encode() for k, _, h, *_ in rows}
    for r in index:
        assert html[r["record_id"]] in gzip.decompress(files[r["archive"]][r["offset"] : r["offset"] + r["length"]])
    assert warc.read_archives(spark, path).count() == len(rows)
