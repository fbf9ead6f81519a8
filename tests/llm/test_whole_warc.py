"""Sound records with gzip bodies in plain archives, and headers of any length."""

import gzip
import random

from pelagia.llm import warc


def record(i, payload, extra=b""):
    return b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\n%sContent-Length: %d\r\n\r\n%s\r\n\r\n" % (i, extra, len(payload), payload)


def read(data):
    got = list(warc.salvage(data))
    return [(x[4]["record_id"], x[4]["payload"]) for x in got if x[0] == "record"], [x[1:4] for x in got if x[0] == "gap"]


def test_gzip_bodies_in_a_plain_archive():
    body = b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\n" + gzip.compress(b"page " * 100, mtime=0)
    a, b, z = record(1, body), record(2, b"two"), gzip.compress(record(3, b"three"), mtime=0)
    assert read(a + b + a) == ([("<urn:page:1>", body), ("<urn:page:2>", b"two"), ("<urn:page:1>", body)], [])
    assert [i for i, _ in read(a + z + b)[0]] == ["<urn:page:1>", "<urn:page:3>", "<urn:page:2>"]
    # A broken frame before a member costs the frame alone.
    bad = b.replace(b"Content-Length: 3", b"Content-Length: 9")
    got, gaps = read(bad + z + a)
    assert [i for i, _ in got] == ["<urn:page:3>", "<urn:page:1>"] and [g[:2] for g in gaps] == [(0, len(bad))]


def test_headers_of_any_length(spark, tmp_path):
    long = b"WARC-Target-URI: data:," + b"x" * 3_000_000 + b"\r\n"
    a, b = record(1, b"one", long), record(2, b"two")
    for data in (a + b, gzip.compress(a + b), gzip.compress(a) + gzip.compress(b)):
        assert read(data) == ([("<urn:page:1>", b"one"), ("<urn:page:2>", b"two")], [])
    torn = a[:200_000]
    assert [i for i, _ in read(torn + b"\n" + b)[0]] == ["<urn:page:2>"]
    assert [i for i, _ in read(gzip.compress(torn + b"\n" + b))[0]] == ["<urn:page:2>"]
    rows = [(1, "data:," + "y" * 200_000, "first"), (2, "http://b", "second")]
    path = str(tmp_path / "archive")
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    assert {r["page_id"] for r in warc.page_records(warc.read_archives(spark, path)).collect()} == {1, 2}


def test_a_flipped_byte_of_a_written_archive_costs_one_record(spark, tmp_path):
    rng = random.Random(5)
    rows = [(k, f"http://{k}", "".join(rng.choices("abcdefgh <>", k=rng.choice([10, 500, 3000])))) for k in range(300)]
    path = tmp_path / "archive"
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2), str(path))
    for part in path.glob("part-*"):
        data = part.read_bytes()
        whole = gzip.decompress(data)  # any reader of gzip takes the file
        assert whole == b"".join(b"WARC/1.1" + x for x in whole.split(b"WARC/1.1")[1:])
        got, gaps = read(data)
        assert len(got) == whole.count(b"WARC/1.1") and not gaps
        for _ in range(60):
            bad = bytearray(data)
            bad[rng.randrange(len(bad))] ^= 1 << rng.randrange(8)
            assert len(read(bytes(bad))[0]) >= len(got) - 1


def test_files_are_bounded_by_bytes(spark, tmp_path):
    rng = random.Random(6)
    sizes = [200_000, 100, 100, 300_000, 50_000, 100, 150_000, 100, 100, 100]
    rows = [(k, "u", rng.randbytes(n // 2).hex()) for k, n in enumerate(sizes)]
    path = tmp_path / "archive"
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), str(path), records_per_file=8, file_bytes=160_000)
    files = [p.stat().st_size for p in path.glob("part-*")]
    assert len(files) > 2 and max(files) < 160_000 + 200_000
    back = warc.read_archives(spark, str(path)).where("kind = 'record'").collect()
    assert sorted(r["payload_bytes"] for r in back) == sorted(sizes)


def test_long_records_in_one_member():
    body = random.Random(7).randbytes(9_000_000)
    data = gzip.compress(record(1, body) + record(2, b"x" * 40_000_000) + record(3, b"end"), 1)
    got, gaps = read(data)
    assert [len(p) for _, p in got] == [9_000_000, 40_000_000, 3] and not gaps
