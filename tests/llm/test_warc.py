"""Archives: round trip, revisits, and assembly of captures from records in any order and direction."""

import gzip
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from gaugeline.llm import queries, warc


def plain(rows):
    sums = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, p in sums:
        if len(p) >= 100 and i is not None:
            first[p] = min(i, first.get(p, i))
    out = []
    for i, p in sums:
        f = first.get(p)
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "response" if f is None or f == i else "revisit", None if f == i else f))
    return sorted(out, key=str)


def awkward():
    r = random.Random(1)
    page = "<p>é 😀</p>" * 20
    rows = [(0, "http://a.example/x?y=1#z", page), (1, None, page), (2, "no address \r\nX: y", page), (3, "http://[bad", None), (4, "", ""),
            (5, "http://ü.example/ß", "x" * 99), (6, "u", "x" * 99), (7, "u", "x" * 100), (8, "u", "x" * 100), (9, "u", "\r\n\r\nWARC/1.1\r\n" * 30),
            (10, "u", "y" * 3_000_000), (11, "u", "\0\x1f\x8b" * 50), (None, "u", page), (None, "u", "only without a key " * 9), (None, None, None),
            (0, "http://a.example/x?y=1#z", page), (-7, "u", "z" * 200), (12, "u", "z" * 200), (12, "u", "z" * 200)]
    return rows + [(100 + i, f"http://h{i % 3}.example/{i}", f"page {r.randint(0, 40)} " * 30) for i in range(200)]


@pytest.mark.parametrize("hot_share", [10_000, 20, 1])
def test_query_equals_plain_form(spark, tmp_path, monkeypatch, hot_share):
    monkeypatch.setattr(warc, "HOT_SHARE", hot_share)
    df = spark.createDataFrame(awkward(), "page_id long, url string, html string").withColumn("key", F.lit("k")).withColumn("digest", F.lit(1))
    df.repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op11_warc_captures(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == plain(awkward())


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert queries.op11_warc_captures(spark, str(tmp_path)).count() == 0


def test_files_hold_gzip_members_and_payloads_come_back(spark, tmp_path):
    rows = [(f"k {i}%+é", f"http://h.example/{i}", f"text {i} é" * 50) for i in range(60)] + [("again", "u", "text 3 é" * 50)]
    pages = spark.createDataFrame(rows, "id string, at string, body string").coalesce(1)
    files = warc.write_archives(warc.with_revisits(pages, "id", "at", "body"), f"file://{tmp_path}/warcs", "2024-05-06T07:08:09Z", 2_000)
    assert files.count() > 3 and all(r.n_bytes < 6_000 for r in files.collect())
    raw = open(files.first().path.removeprefix("file://"), "rb").read()
    assert raw.count(b"\x1f\x8b\x08") >= files.first().n_records and gzip.decompress(raw).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    captures = warc.assemble(warc.read_records(files)).withColumn("key", warc.key_of("key")).collect()
    stored = {r.key: r.response.payload.decode() for r in captures if r.response.type == "response"}
    assert stored == {k: t for k, _, t in rows if k != rows[3][0]}  # "again" comes before it
    assert len(captures) == 61 and all(r.n_requests == r.n_responses == r.n_metadata == 1 for r in captures)
    assert all(r.response.digest_right is not False and r.response.date == "2024-05-06T07:08:09Z" for r in captures)
    assert {r.request.start_line for r in captures} >= {f"GET /{i} HTTP/1.1" for i in range(60)}


def record(kind, name, *concurrent, block=b"", content="text/plain"):
    lines = [f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {name}\r\nContent-Type: {content}\r\nContent-Length: {len(block)}\r\n",
             *(f"WARC-Concurrent-To: {c}\r\n" for c in concurrent)]
    return "".join(lines).encode() + b"\r\n" + block + b"\r\n\r\n"


@pytest.mark.parametrize("packed", ["each", "whole", "plain"])
def test_foreign_archives_are_assembled_in_any_direction(spark, tmp_path, packed):
    records = [
        record("warcinfo", "<w>"), record("metadata", "<m1>", "<q1>", block=b"a: 1\r\n b\r\n", content="application/warc-fields"), record("response", "<r1>"),
        record("request", "<q1>", "<r1>"), record("response", "<r2>", "<q2>", "<m2>"), record("request", "<q2>"), record("metadata", "<m2>"),
        record("resource", "<r3>", block=b"\r\n\r\nWARC/1.0\r\n"), record("request", "<q4>", "<gone>"), record("metadata", "<m5>"),
        record("metadata", "<m6>", "<q1>", "<r1>"), record("metadata", "<m7>", "<m1>"), record("response", "<r8>", "<r1>")]
    random.Random(packed).shuffle(records)
    pack = {"each": lambda rs: b"".join(map(gzip.compress, rs)), "whole": lambda rs: gzip.compress(b"".join(rs)), "plain": b"".join}[packed]
    for k in range(2):
        (tmp_path / f"{k}.warc").write_bytes(pack(records[k::2]))
    files = spark.createDataFrame([(f"file://{tmp_path}/{k}.warc",) for k in range(2)], "path string")
    rows = {r.capture_id: r for r in warc.assemble(warc.read_records(files)).collect()}
    shape = {k: (r.response and r.response.record_id, r.request and r.request.record_id, r.metadata and r.metadata.record_id, r.n_metadata) for k, r in rows.items()}
    assert shape == {"<r1>": ("<r1>", "<q1>", "<m1>", 3), "<r2>": ("<r2>", "<q2>", "<m2>", 1), "<r3>": ("<r3>", None, None, 0),
                     "<gone>": (None, "<q4>", None, 0), "<m5>": (None, None, "<m5>", 1), "<r8>": ("<r8>", None, None, 0)}
    assert rows["<r1>"].metadata.fields == {"a": "1 b"} and bytes(rows["<r3>"].response.payload) == b"\r\n\r\nWARC/1.0\r\n"


@pytest.mark.parametrize("raw", [b"no archive\r\n", record("response", "<r>", block=b"abc")[:-6], b"WARC/1.0\r\nWARC-Type: x\r\n", b"WARC/1.0\r\nA: b\r\n\r\n"])
def test_broken_archives_fail(raw):
    with pytest.raises((ValueError, KeyError)):
        list(warc.records_of(io.BytesIO(raw)))
