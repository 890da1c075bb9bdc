import gzip
import hashlib
import os

import pytest

from sunset_engine.llm import warc as W

SCHEMA = "page_id long, url string, html string, digest string, copies int"
HEAVY = "x" * 1000 + "WARC/1.1\r\nWARC-Type: response\r\n\r\n" + "é" * 777 + "WARC/1.1"


def expected(rows):
    body = [(p, (h or "").encode()) for p, _, h in rows]
    first = {}
    for p, b in body:
        if len(b) >= 100 and p is not None:
            first[b] = min(p, first.get(b, p))
    out = []
    for p, b in body:
        to = first.get(b)
        copies = sum(x == b for _, x in body)
        revisit = len(b) >= 100 and copies > 1 and to is not None and p != to
        out.append((str(p), len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", str(to if revisit else None)))
    return sorted(out)


ROWS = [(1, "http://a/WARC/1.1", "y" * 100), (2, None, "y" * 100), (3, "http://b/ \r\nX: y", "y" * 99), (4, "u", "y" * 99), (5, "u", None), (6, "u", ""),
        (7, "u", HEAVY), (8, "u", HEAVY), (9, "u", "WARC/1.1"), (10, "u", "WARC/1.1WARC/1.1\r\n" * 30), (11, "u", "z\r\n\r\n" * 5000), (None, "u", "y" * 100),
        (12, "u", "\r\n\r\nWARC/"), (13, "u", "1.1\r\n" * 50), (2, None, "y" * 100), (1, "http://a/WARC/1.1", "y" * 100), (7, "u", HEAVY)]


@pytest.mark.parametrize("chunk", [W.CHUNK_CHARS, 64])
def test_round_trip(spark, tmp_path, chunk):
    path = str(tmp_path / "a")
    W.write_warc(spark.createDataFrame([(*r, "d", 3) for r in ROWS], SCHEMA), path, chunk_chars=chunk)
    got = W.payloads(W.read_warc(spark, path)).collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got) == expected(ROWS)
    found = W.read_warc(spark, path).collect()
    assert max(len(r.chunk) for r in found) <= chunk


def test_files_hold_plain_records(spark, tmp_path):
    path = str(tmp_path / "a")
    W.write_warc(spark.createDataFrame([(1, "http://a/", "héllo", "", 0)], SCHEMA), path)
    raw = b"".join(gzip.open(os.path.join(path, f)).read() for f in sorted(os.listdir(path)) if f.endswith(".gz"))
    head, body = raw.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    assert lines[0] == "WARC/1.1" and "Content-Length: 6" in lines and "WARC-Record-ID: <urn:page:1>" in lines
    assert body == "héllo".encode() + b"\r\n\r\n"


def test_a_damaged_record_fails(spark, tmp_path):
    path = tmp_path / "a"
    path.mkdir()
    (path / "x.txt").write_bytes(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n")
    with pytest.raises(Exception, match="cut short"):
        W.read_warc(spark, str(path)).collect()


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "a")
    W.write_warc(spark.createDataFrame([], SCHEMA), path)
    assert W.payloads(W.read_warc(spark, path)).collect() == []
