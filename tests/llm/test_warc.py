"""Archives against the pages they were made of; merging against sorting."""

import base64
import gzip
import hashlib
import random

from pyspark.sql import functions as F

from quotemill.llm import warc
from quotemill.llm.loser_tree import merge


def table(spark, data):
    return spark.createDataFrame(data, "page_id long, url string, html string")


def brute(data):
    out = []
    for page, _, html in data:
        payload = (html or "").encode()
        ids = [p for p, _, h in data if (h or "") == (html or "") and p is not None]
        first = min(ids) if ids else None
        response = first is None or page == first
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page, len(payload), digest, "response" if response else "revisit", None if response else first))
    return sorted(out, key=repr)


DATA = [
    (1, "http://www.b.example/x y?q=1", "<p>é</p>"), (2, "https://a.example/", "<p>é</p>"), (3, None, None), (4, "http://c.example\r\nX: y", ""),
    (5, "http://[bad", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nb\n"), (6, "", "\r\n\r\n"), (None, "http://a.example/", "<p>é</p>"),
    (None, "u", "only"), (7, "http://a.example/", "x" * 300_000), (7, "http://a.example/", "x" * 300_000), (-9, "http://ü.example/ü", "日本")]


def test_round_trip(spark, rows):
    index = warc.archived(table(spark, DATA).withColumns({"digest": F.lit(1), "n": F.lit(2), "first": F.lit(3)}))
    assert rows(index, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == brute(DATA)
    urls = {r.page_id: r.url for r in index.collect()}
    assert urls[1] == "http://www.b.example/x%20y?q=1" and urls[4] == "http://c.example%0D%0AX:%20y" and urls[3] is None


def test_small_payloads_are_responses(spark):
    data = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]
    got = {r.page_id: r.record_type for r in warc.archived(table(spark, data), least_bytes=3).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_index_is_in_order_over_many_files(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    monkeypatch.setattr(warc, "RANGE_ROWS", 50)
    rng = random.Random(1)
    data = [(i, f"http://h{rng.randrange(3)}.example/p{rng.randrange(4)}", f"body {rng.randrange(50)}") for i in range(400)]
    index = warc.archived(table(spark, data).repartition(5)).withColumn("part", F.spark_partition_id()).collect()
    assert len({r.file for r in index}) > 20 and len({r.part for r in index}) > 4
    order = [(r.url_key, r.timestamp, r.page_id) for r in index]
    assert order == sorted(order) and [r.part for r in index] == sorted(r.part for r in index)
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in index) == sorted(brute(data))


def test_empty(spark, rows):
    assert rows(warc.archived(table(spark, []))) == []


def test_url_keys():
    assert warc.url_key("HTTP://www.Example.org/A?b=1") == "org,example)/a?b=1"
    assert warc.url_key("http://example.org") == "org,example)/" and warc.url_key(None) == "" and warc.url_key("http://[x") == "http://[x"


def test_merge_equals_sorting():
    rng = random.Random(7)
    for k in [0, 1, 2, 3, 5, 8, 13]:
        for _ in range(30):
            runs = [sorted(rng.randrange(20) for _ in range(rng.randrange(9))) for _ in range(k)]
            got = list(merge([[(key, (i, p)) for p, key in enumerate(run)] for i, run in enumerate(runs)]))
            want = sorted(((key, (i, p)) for i, run in enumerate(runs) for p, key in enumerate(run)), key=lambda x: (x[0], x[1]))
            assert got == want


def test_merging_holds_one_item_of_each_run():
    read = [0, 0, 0]

    def run(i):
        for key in range(1000):
            read[i] += 1
            yield key, i

    merged = merge([run(i) for i in range(3)])
    for _ in range(30):
        next(merged)
    assert max(read) <= 12


def files_of(spark, path):
    return {r.path.rsplit("/", 1)[-1]: bytes(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()}


def test_a_record_is_read_by_its_place_alone(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_warc(table(spark, DATA), path)
    content = files_of(spark, path)
    index = warc.read_warc(spark, path).collect()
    assert len(index) == len(DATA)
    for r in index:
        fields, block = warc.record(gzip.decompress(content[r.file][r.offset:r.offset + r.length]))
        assert fields["warc-type"] == r.record_type
        payload = block[block.index(b"\r\n\r\n") + 4:]
        if r.record_type == "response":
            assert base64.b32encode(hashlib.sha1(payload).digest()).decode() == r.payload_digest and len(payload) == r.payload_bytes
    for name, data in content.items():  # whole files are plain gzip as well
        assert gzip.decompress(data).count(b"WARC/1.1\r\nWARC-Type") >= sum(r.file == name for r in index)


def test_files_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 40_000)
    rng = random.Random(2)
    sizes = [rng.choice([10, 100, 30_000, 300_000]) for _ in range(60)]
    data = [(i, "http://a.example/", rng.randbytes(n // 2).hex()) for i, n in enumerate(sizes)]
    path = str(tmp_path / "archive")
    warc.write_warc(table(spark, data).repartition(3), path)
    index, content = warc.read_warc(spark, path), files_of(spark, path)
    longest = {f: max(r.length for r in index.collect() if r.file == f) for f in content if content[f]}
    assert len(longest) > 10 and all(len(content[f]) <= 40_000 + n for f, n in longest.items())
    got = warc.capture_index(index).collect()
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == sorted(brute(data))


def test_a_record_of_more_than_16_mb(spark, tmp_path):
    data = [(1, "u", "x" * (17 << 20)), (2, "v", "short"), (3, "w", "y" * (16 << 20))]
    path = str(tmp_path / "archive")
    warc.write_warc(table(spark, data).coalesce(1), path)
    got = warc.read_warc(spark, path).collect()
    assert sorted((r.page_id, r.payload_bytes) for r in got) == [(1, 17 << 20), (2, 5), (3, 16 << 20)]
