"""WARC archives: round trips, byte ranges of any size, payloads that hold WARC members."""

import gzip
import os
import random

import pytest

from lakelog.llm import warc

SCHEMA = "page_id long, url string, html string, sha1 int"


def pages(seed=1):
    r = random.Random(seed)
    rows = [(0, "http://a/ b\r\nX: y", "same"), (5, None, "same"), (3, "http://c", "same"), (7, "u", None), (8, "u", ""), (9, "u", "é\r\n\r\nWARC/1.1")]
    rows += [(None, "u", "same"), (None, "u", "alone"), (20, "u", "twice"), (20, "u", "twice"), (21, "u", "twice")]
    rows += [(100 + k, f"http://x/{k}", "".join(chr(r.randint(32, 0x2FF)) for _ in range(r.randint(0, 3000)))) for k in range(60)]
    rows.append((500, "big", "z" * 300_000 + "".join(chr(r.randint(32, 0xFFF)) for _ in range(200_000))))
    return rows


def expected(rows, min_bytes=0):
    first = {}
    for k, _, html in rows:
        body = (html or "").encode()
        if k is not None and len(body) >= min_bytes:
            first[body] = min(k, first.get(body, k))
    out = []
    for k, _, html in rows:
        body = (html or "").encode()
        other = first.get(body)
        other = None if other == k else other
        out.append((k, len(body), warc.digest(body), "response" if other is None else "revisit", other))
    return sorted(map(repr, out))


def digest_rows(found):
    cut = lambda x: None if x is None or x == "urn:page:" else int(x.removeprefix("urn:page:"))
    return sorted(repr((cut(x.record_id), x.payload_bytes, x.payload_digest, x.record_type, cut(x.refers_to))) for x in found)


@pytest.mark.parametrize("size,min_bytes", [(64 << 20, 0), (20_000, 0), (3_001, 5)])
def test_round_trip(spark, folder, size, min_bytes):
    rows = pages()
    warc.write(spark.createDataFrame([(*x, 1) for x in rows], SCHEMA).repartition(3), folder, min_bytes=min_bytes)
    found = warc.read(spark, folder, size).collect()
    assert digest_rows(found) == expected(rows, min_bytes)
    bodies = {x.record_id: bytes(x.payload) for x in found if x.record_type == "response"}
    assert bodies["urn:page:9"] == "é\r\n\r\nWARC/1.1".encode()
    assert {x.target_uri for x in found if x.record_id == "urn:page:0"} == {"http://a/%20b%0D%0AX:%20y"}


def test_archives_are_plain_gzip(spark, folder):
    warc.write(spark.createDataFrame([(*x, 1) for x in pages()], SCHEMA).coalesce(1), folder)
    names = [f for f in os.listdir(folder) if f.startswith("part-")]
    raw = b"".join(gzip.open(f"{folder}/{f}").read() for f in names)
    assert raw.count(b"WARC/1.1\r\nWARC-Type") == len(pages())


@pytest.mark.parametrize("size", [100, 777, 1 << 20])
def test_members_inside_payloads_are_no_records(spark, tmp_path, size):
    """A payload that is an archive of its own, stored without compression."""
    inner = b"".join(warc.record(f"inner:{k}", None, os.urandom(40), None) for k in range(20))
    outer = warc.record("outer:1", None, b"first", None)
    outer += warc.record("outer:2", None, b"junk \x1f\x8b\x08 " + inner, None, level=0)
    outer += b"not a member" + warc.record("outer:3", None, b"last", None)
    (tmp_path / "x.warc.gz").write_bytes(outer)
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    found = warc.read(spark, f"file://{tmp_path}", size).collect()
    assert sorted(x.record_id for x in found) == ["outer:1", "outer:2", "outer:3"]


def test_no_pages(spark, folder):
    warc.write(spark.createDataFrame([], SCHEMA), folder)
    assert warc.read(spark, folder).count() == 0
