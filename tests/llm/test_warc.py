import base64
import glob
import hashlib
import random

from tidemark.llm import warc
from tidemark.llm.common import scratch

SCHEMA = "page_id long, url string, html string, digest string"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def there_and_back(spark, rows, parts=3):
    path = scratch(spark, "warc-test")
    warc.write_warc(spark.createDataFrame(rows, SCHEMA).repartition(parts), path)
    return path, warc.resolve_revisits(warc.read_warc(spark, path)).collect()


def pages():
    r = random.Random(4)
    inner = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    fake = "before\r\n\r\n" + "".join(inner.format(n, "x" * n) for n in (0, 5, 40)) + "after"
    out = [fake, fake + "\r\n\r\n", "WARC/1.0\r\n", "\r\n\r\nWARC/1.0\r\n", "\r\n\r\nWARC/1.0\r\n" * 50, fake * 3, "", None, "\r\n\r\n",
           "é🙂" * 500, "Content-Length: 3\r\n\r\n", "z" * 200_000 + "\r\n\r\nWARC/1.0\r\n" + "z" * 100]
    out += ["".join(r.choice(["\r\n\r\n", "WARC/1.0\r\n", "a", "é", "Content-Length: 7\r\n"]) for _ in range(r.randint(0, 30)))
            for _ in range(80)]
    return [(i, f"http://h/{i}" if i % 5 else None, t, "x") for i, t in enumerate(out + out[:20])]


def test_round_trip_with_archives_inside_payloads(spark):
    rows = pages()
    _, got = there_and_back(spark, rows)
    assert sorted(int(r["id"]) for r in got) == [r[0] for r in rows]
    last = {}
    for i, _, t, _ in rows:
        last[t or ""] = i
    for r in got:
        i = int(r["id"])
        t = rows[i][2] or ""
        assert (r["payload_bytes"], r["payload_digest"]) == (len(t.encode()), digest(t)), i
        want = ("response", None) if last[t] == i else ("revisit", str(last[t]))
        assert (r["type"], r["refers_to"]) == want, i


def test_small_splits_give_the_same_records(spark):
    path, got = there_and_back(spark, pages())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        again = warc.resolve_revisits(warc.read_warc(spark, path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    key = lambda rs: sorted((int(r["id"]), r["payload_digest"], r["type"], r["refers_to"] or "") for r in rs)
    assert key(got) == key(again)


def test_payloads_are_read_whole(spark):
    rows = pages()
    _, got = there_and_back(spark, rows)
    for r in got:
        if r["type"] == "response":
            assert bytes(r["payload"]).decode() == (rows[int(r["id"])][2] or "")


def test_repeated_rows_and_null_ids(spark):
    _, got = there_and_back(spark, [(1, "u", "same", "x"), (1, "u", "same", "x"), (2, None, "same", "x"), (None, None, None, None)])
    assert sorted((r["id"] or "", r["type"], r["refers_to"] or "") for r in got) == [
        ("", "response", ""), ("1", "revisit", "2"), ("1", "revisit", "2"), ("2", "response", "")]


def test_files_start_with_a_record(spark):
    path, _ = there_and_back(spark, pages()[:20], 2)
    files = [f for f in glob.glob(path.removeprefix("file://") + "/*") if not f.rsplit("/", 1)[1].startswith(("_", "."))]
    assert files and all(open(f, "rb").read(10) == b"WARC/1.0\r\n" for f in files)


def test_empty_table(spark):
    _, got = there_and_back(spark, [])
    assert got == []


def test_records_that_share_an_id_keep_their_own_payloads(spark):
    rows = [(5, "u", "AAAA", "x"), (5, "u", "BBBBBB", "x"), (3, "u", "AAAA", "x"), (2, "u", "BBBBBB", "x"), (1, "u", "AAAA", "x")]
    _, got = there_and_back(spark, rows)
    assert sorted((int(r["id"]), r["payload_bytes"], r["payload_digest"], r["type"], r["refers_to"]) for r in got) == sorted(
        [(5, 4, digest("AAAA"), "response", None), (5, 6, digest("BBBBBB"), "response", None), (3, 4, digest("AAAA"), "revisit", "5"),
         (2, 6, digest("BBBBBB"), "revisit", "5"), (1, 4, digest("AAAA"), "revisit", "5")])


def record(version, n, body):
    block = f"HTTP/1.1 200 OK\r\n\r\n{body}"
    return (f"WARC/{version}\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{n}>\r\nContent-Type: application/http; msgtype=response\r\n"
            f"Content-Length: {len(block)}\r\n\r\n{block}\r\n\r\n").encode()


def archive(name, data):
    import os
    import tempfile
    folder = tempfile.mkdtemp(prefix="run-")
    with open(os.path.join(folder, name), "wb") as f:
        f.write(data)
    return folder


def test_both_versions_are_read(spark):
    folder = archive("a.warc", b"".join(record("1.1" if n % 3 else "1.0", n, "x" * n) for n in range(200)))
    got = {int(r["id"]): r["payload_bytes"] for r in warc.read_warc(spark, folder).collect()}
    assert got == {n: n for n in range(200)}


def test_compressed_and_broken_archives_raise(spark):
    import gzip

    import pytest
    whole = b"".join(record("1.0", n, "x" * 20) for n in range(50))
    with pytest.raises(ValueError, match="compressed"):
        warc.read_warc(spark, archive("a.warc.gz", gzip.compress(whole)))
    at = len(whole) // 2
    for data in (whole[:-30], whole[:at] + b"noise" + whole[at:], b"noise" + whole):
        folder = archive("a.warc", data)
        with pytest.raises(warc.BrokenArchive):
            warc.read_warc(spark, folder).collect()
        assert warc.read_warc(spark, folder, broken="keep").count() < 50
    assert warc.read_warc(spark, archive("a.warc", whole)).count() == 50
