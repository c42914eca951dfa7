import gzip
import hashlib
import os
import random

import pytest

from pressgrain.llm import warc


def test_chunked_framing():
    rng = random.Random(1)
    for n in (0, 1, 5, 4096, 5000):
        payload = rng.randbytes(n)
        framed = warc.chunked(payload, 16)
        assert warc.unchunked(framed) == payload
        assert warc.unchunked(framed[:-5]) is None or n == 0
    assert warc.unchunked(b"4;name=x\r\nabcd\r\n0\r\n\r\n") == b"abcd"
    assert warc.unchunked(b"zz\r\nabcd\r\n0\r\n\r\n") is None
    assert warc.payload_of(b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nplain") == b"plain"


def test_round_trip(spark, tmp_path):
    rng = random.Random(2)
    trap = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n"
    big = "é" * 700 + "x"
    rows = [(i, f"http://h/{i}", "".join(rng.choice("ab\r\n ü") for _ in range(rng.randint(0, 3000)))) for i in range(30)]
    rows += [(100, None, None), (101, "u\r\nX: y", ""), (102, "", trap * 40), (103, "", trap), (104, "", "<html>" * 40_000)]
    rows += [(200, "a", big), (201, "b", big), (210, "c", big), (202, "d", "short"), (203, "d", "short"), (-5, "n", big)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, payload string")
    path = str(tmp_path / "archives")
    got = {r["page_id"]: tuple(r)[1:] for r in warc.round_trip(pages, path, segment=500).collect()}
    assert len(got) == len(rows)
    for page_id, _, html in rows:
        raw = (html or "").encode()
        kept = max(p for p, _, h in rows if (h or "") == (html or ""))
        again = len(raw) >= 1000 and kept != page_id
        assert got[page_id] == (
            len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", kept if again else None, True
        )
    read = {r["page_id"]: r for r in warc.read_pages(spark, path).collect()}
    assert bytes(read[102]["payload"]).decode() == trap * 40
    assert read[200]["payload"] is None and bytes(read[210]["payload"]).decode() == big


def archive(path, records):
    os.makedirs(path)
    with gzip.open(f"{path}/a.warc.gz", "wb") as f:
        for r in records:
            f.write(r + b"\r\n\r\n")
    return str(path)


def test_broken_segments_are_told(spark, tmp_path):
    payload = b"0123456789" * 300
    whole = warc.page_records(1, "u", payload, hashlib.sha1(payload).hexdigest(), None, 500)
    missing = warc.page_records(2, "u", payload, hashlib.sha1(payload).hexdigest(), None, 500)
    wrong = warc.page_records(3, "u", payload, "0" * 40, None, 500)
    orphan = warc.page_records(4, "u", payload, hashlib.sha1(payload).hexdigest(), None, 500)[1:]
    cut = warc.page_records(5, "u", payload, hashlib.sha1(payload).hexdigest(), None, 500)[:-1]
    records = [*whole, *missing[:2], *missing[3:], *wrong, *orphan, *cut]
    random.Random(3).shuffle(records)
    path = archive(tmp_path / "x", records)
    got = {r["page_id"]: r["intact"] for r in warc.read_pages(spark, path).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_missing_id_and_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([(None, "u", "x")], "page_id long, url string, html string")
    with pytest.raises(Exception, match="page_id"):
        warc.write_archives(pages, str(tmp_path / "a"))
    assert warc.round_trip(pages.limit(0), str(tmp_path / "b")).count() == 0


def test_repeated_and_null_ids(spark, tmp_path):
    big, other, small = "ab" * 3000, "xy\n" * 1500, "few"
    rows = [(1, "u", big), (1, "u", big), (1, "u", other), (1, "u", small), (1, "u", small), (2, "v", other), (2, "v", other),
            (0, "w", big), (0, "w", big), (0, "w", other), (None, "n", big), (None, "n", big), (None, None, None), (3, "x", "cd" * 4000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = str(tmp_path / "archives")
    got = sorted((tuple(r) for r in warc.round_trip(pages, path, segment=500).collect()), key=str)
    want = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        kept = max((p for p, _, h in rows if (h or "") == (html or "") and p is not None), default=None)
        again = len(raw) >= 1000 and page_id is not None and kept != page_id
        want.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", kept if again else None, True))
    assert got == sorted(want, key=str)
    ids = [(r["id"], r["refers_to"]) for r in warc.read_records(spark, path).collect()]
    assert len({i for i, _ in ids}) == len(ids)
    assert {r for _, r in ids if r} <= {i for i, _ in ids}
