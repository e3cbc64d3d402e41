"""Operator 13: archives read back by byte ranges of any size, against the pages and a plain reader."""

import base64
import gzip
import hashlib
import io
import random
import zlib

import pytest
from pyspark.sql import functions as F

from graphspark.llm import queries, warc

from .conftest import CLASH, SF, words

BODY = "<p>" + words(40, 5)
PAGES = [(1, "http://a.b/1", BODY), (2, "http://a.b/2", BODY), (3, None, BODY), (4, "u\r\nX: y ", ""), (5, "v", None),
         (None, "w", "only"), (None, "w2", "also"), (None, "w3", "also"), (6, "x", words(30_000, 6)),
         (7, "r", "twice"), (7, "r", "twice"), (8, "é", "naïve \U0001f600 \r\n\r\n WARC/1.1\r\n"), (-9, "n", "minus")]


@pytest.fixture(scope="module")
def pages(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return df.select("*", *[F.lit(v).alias(c) for c, v in (CLASH | {"_body": "b", "path": "p", "_sha": "s"}).items()])


def brute(rows):
    groups = {}
    for page_id, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page_id)
    out = []
    for body, ids in groups.items():
        sha = base64.b32encode(hashlib.sha1(body).digest()).decode()
        ids.sort(key=lambda i: (i is not None, i or 0))
        top = ids.pop()
        out.append((top, len(body), sha, "response", None))
        out += [(i, len(body), sha, "revisit", top) for i in ids]
    return sorted(out, key=repr)


def rows_of(df):
    assert df.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("split", [700, 5_000, warc.SPLIT_BYTES])
def test_round_trip_equals_brute_force(pages, split):
    assert rows_of(warc.round_trip(pages, split)) == brute(PAGES)


def test_query_equals_brute_force(spark, real):
    rows = [tuple(r) for r in real["pages"].select("page_id", "url", "html").collect()]
    assert rows_of(queries.archives(spark, SF)) == brute(rows)


def test_empty_table_and_small_payloads(pages):
    assert warc.round_trip(pages.limit(0)).count() == 0
    types = {r["page_id"]: r["type"] for r in warc.read(warc.archive(pages, min_bytes=100))
             .select(warc.page_of(F.col("record_id")).alias("page_id"), "type").collect()}
    assert [types[i] for i in (1, 2, 3, 7, 4, 5)] == ["revisit", "revisit"] + ["response"] * 4


def test_payloads_urls_and_files_are_whole(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 3_000)
    files = warc.archive(pages.repartition(2))
    assert files.agg(F.sum("records")).first()[0] == len(PAGES) and files.count() > 2
    for path, length, _ in files.collect():
        data = open(path.removeprefix("file:"), "rb").read()
        assert len(data) == length and gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    folder = files.first()["path"].rsplit("/", 1)[0]
    assert sorted(warc.files_in(spark, folder).select("length").collect()) == sorted(files.select("length").collect())
    records = {r["record_id"]: r for r in warc.read(files, 512).collect()}
    for r in records.values():
        if r["type"] == "revisit":
            assert r["payload"] is None and records[r["refers_to"]]["payload_digest"] == r["payload_digest"]
        else:
            assert warc.digest(r["payload"]) == r["payload_digest"]
    bodies = sorted(r["payload"].decode() for r in records.values() if r["type"] == "response")
    assert bodies == sorted({h or "" for _, _, h in PAGES})
    uris = {r["uri"] for r in records.values()}
    assert {"u%0D%0AX:%20y%E2%80%A8", "é", None} <= uris


def member(n, block, stored=False, more=b""):
    fields = [("WARC-Type", "resource"), ("WARC-Record-ID", f"<urn:x:{n}>")]
    if not stored:
        return warc.member_of(fields, block)
    coder = zlib.compressobj(0, zlib.DEFLATED, 31)
    header = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x:{n}>\r\nContent-Length: {len(block)}\r\n\r\n".encode()
    return coder.compress(header + block + b"\r\n\r\n" + more) + coder.flush()


def scanned(data, split):
    for first in range(0, len(data), split):
        for row in warc.scan(Sized(data), first, first + split):
            yield {"path": "f", "range_start": first, **row}


class Sized(io.BytesIO):
    def size(self):
        return len(self.getvalue())



@pytest.mark.parametrize("split", [64, 1_000, 10**6])
def test_false_magic_damage_and_junk(split):
    rng = random.Random(4)
    noise = [rng.randbytes(400) + warc.MAGIC + rng.randbytes(300) for _ in range(6)]
    whole = [member(n, block, stored=n % 2) for n, block in enumerate(noise)]
    assert [r["record_id"] for r in scanned(b"".join(whole), split)] == [f"<urn:x:{n}>" for n in range(6)]
    broken = bytearray(whole[3])
    broken[-30] ^= 255  # its check sum is wrong
    data = b"junk" + b"".join(whole[:3]) + bytes(broken) + whole[4] + b"\0" * 50 + gzip.compress(b"no record") + whole[5][:-40]
    rows = list(scanned(data, split))
    assert [r.get("record_id") for r in rows] == ["<urn:x:0>", "<urn:x:1>", "<urn:x:2>", None, "<urn:x:4>", None]
    assert [bool(r.get("error")) for r in rows] == [False] * 3 + [True, False, True]
    assert list(scanned(b"", split)) == []


def test_several_records_in_a_member():
    two = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x:8>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = list(scanned(member(7, b"x" * 10, stored=True, more=two) + member(9, b"y"), 50))
    assert [(r["record_id"], r["place"]) for r in rows] == [("<urn:x:7>", 0), ("<urn:x:8>", 1), ("<urn:x:9>", 0)]


@pytest.mark.parametrize("split", [97, 512, 10**6])
def test_archive_inside_an_archive(spark, split, tmp_path):
    inner = b"".join(member(f"in{n}", random.Random(n).randbytes(150)) for n in range(8))
    data = member("a", b"first") + member("b", inner, stored=True) + member("c", b"last")
    (tmp_path / "f.warc.gz").write_bytes(data)
    records = warc.read(warc.files_in(spark, str(tmp_path)), split).drop("payload")
    ids = [r["record_id"] for r in warc.genuine(warc.materialize(records)).orderBy("start").collect()]
    assert ids == ["<urn:x:a>", "<urn:x:b>", "<urn:x:c>"]
