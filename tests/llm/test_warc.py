from __future__ import annotations

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from orderloom.llm import warc
from orderloom.llm.queries import QUERIES
from orderloom.session import run_dir

SF = "/root/testdata/sf0.001"


def name(html: str | None) -> str:
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def brute(rows):
    """(page_id, bytes, digest, type, refers_to) by the contract."""
    most: dict = {}
    for i, html in rows:
        if i is not None:
            most[html or ""] = max(i, most.get(html or "", i))
    out = []
    for i, html in rows:
        first = most.get(html or "")
        size = len((html or "").encode())
        revisit = first is not None and i != first
        out.append((i, size, name(html), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def found(df):
    rows = df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem").collect()
    assert all(r.problem is None for r in rows)
    return sorted((tuple(r)[:5] for r in rows), key=repr)


def test_query_against_brute_force(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert found(QUERIES["op4_warc_segments"](spark, SF)) == brute([(p.page_id, p.html) for p in pages])


def test_odd_rows(spark, tmp_path):
    rows = [(1, "http://a b\n/é?q=\"<>", None), (2, None, ""), (3, "u", "é😀" * 40_000), (4, "u", "é😀" * 40_000),
            (4, "u", "é😀" * 40_000), (5, "v", "\r\n\r\nWARC/1.1\r\n0\r\n\r\n"), (None, "w", "x"), (None, "w", "x"),
            (6, "w", "y"), (None, "w", "y")]
    rows += [(i, "u", "copy") for i in range(100, 400)]
    pages = spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id long, url string, html string, id string, n int")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    assert found(QUERIES["op4_warc_segments"](spark, str(tmp_path))) == brute([(r[0], r[2]) for r in rows])


def test_round_trip_of_payloads(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    path = run_dir(spark, "warc_test")
    warc.write_pages(pages, path, segment=500, file_bytes=20_000)
    back = warc.read_records(spark, path)
    got = back.filter("type = 'response'").select(F.split("record_id", ":")[2].cast("long"), F.decode("payload", "UTF-8"))
    assert sorted(map(tuple, got.collect())) == sorted((p.page_id, p.html) for p in pages.collect())
    numbers = warc.pieces(spark, path, segmented=True).agg(F.max("number")).first()[0]
    assert numbers > 5


def test_small_payloads_are_no_revisits(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    path = run_dir(spark, "warc_test")
    warc.write_pages(pages, path, min_bytes=3)
    got = warc.read_records(spark, path).select(F.split("record_id", ":")[2].cast("int"), "type").collect()
    assert sorted(map(tuple, got)) == [(1, "response"), (2, "response"), (3, "revisit"), (4, "response")]


def test_no_rows(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert QUERIES["op4_warc_segments"](spark, str(tmp_path)).count() == 0


def _piece(data):
    return [{**p} for _, part in warc._members(data) for _, p in warc.parse(part)]


def test_reassembly_checks():
    records = [*warc.page_records("urn:x:1", "u", b"payload" * 200, warc.digest_of(b"payload" * 200), None, 300)]
    pieces = [p for r in records for p in _piece(warc._member(r))]
    assert len(pieces) > 3
    assert warc._joined(pieces)["payload"] == b"payload" * 200
    assert warc._joined(pieces[:-1])["problem"] == "segment missing"
    assert warc._joined(pieces[:1] + pieces[2:])["problem"] == "segment missing"
    short = [*pieces[:-1], {**pieces[-1], "block": pieces[-1]["block"][:-1]}]
    assert warc._joined(short)["problem"] == "total length differs"
    other = [{**pieces[0], "digest": "sha1:" + warc.digest_of(b"")}, *pieces[1:]]
    assert warc._joined(other)["problem"] == "digest differs"


@pytest.mark.parametrize("body", [b"5\r\nab", b"zz\r\nab\r\n", b"3\r\nabcd\r\n0\r\n\r\n", b""])
def test_damaged_framing(body):
    with pytest.raises(ValueError):
        warc.dechunked(body)


def test_damaged_archives_keep_what_was_read(spark):
    path = run_dir(spark, "warc_test")
    records = [warc._member(r) for i in range(3) for r in warc.page_records(f"urn:x:{i}", "u", b"p%d" % i, warc.digest_of(b"p%d" % i), None, 9999)]
    from orderloom.llm.common import put_file

    put_file(f"{path}/cut.warc.gz", b"".join(records)[:-5], "t")
    put_file(f"{path}/plain.warc", b"".join(d for _, d in warc._members(records[0])), "t")
    put_file(f"{path}/junk.warc", b"this is no archive", "t")
    got = warc.read_records(spark, path).select("record_id", "problem").collect()
    assert sorted((r.record_id or "", r.problem or "") for r in got) == [
        ("", "archive cut short"), ("", "not a record"), ("urn:x:0", ""), ("urn:x:0", ""), ("urn:x:1", ""),
    ]


def test_reading_goes_on_behind_damage(spark):
    from orderloom.llm.common import put_file

    def made(i):
        body = b"page %d " % i * 20
        return b"".join(warc._member(r) for r in warc.page_records(f"urn:x:{i}", "u", body, warc.digest_of(body), None, 9999))

    path = run_dir(spark, "warc_test")
    members = [made(i) for i in range(50)]
    hurt = bytearray(b"".join(members))
    at = len(b"".join(members[:12])) + len(members[12]) // 2
    hurt[at : at + 6] = b"\xff" * 6
    start = len(b"".join(members[:30]))
    hurt[start : start + 3] = b"abc"  # this member does not even begin
    put_file(f"{path}/hurt.warc.gz", bytes(hurt), "t")
    plain = [b"".join(d for _, d in warc._members(m)) for m in members[:5]]
    plain[1] = plain[1].replace(b"Content-Length", b"Content-Longth", 1)
    plain[3] = b"junk\r\n" + plain[3][9:]
    put_file(f"{path}/plain.warc", b"".join(plain), "t")
    got = warc.read_records(spark, path).select("record_id", "problem").collect()
    ids = sorted(int(r.record_id.split(":")[2]) for r in got if r.record_id)
    assert ids == sorted([*(i for i in range(50) if i not in (12, 30)), 0, 2, 4])
    assert len([r for r in got if r.problem]) == 4


def test_ids_of_any_sign(spark, tmp_path):
    rows = [(-5, "u", "same"), (3, "u", "same"), (-9, "v", "other"), (None, "w", "none"), (-(2**63), "x", "least")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = QUERIES["op4_warc_segments"](spark, str(tmp_path)).select("page_id", "record_type", "refers_to").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(
        [(-5, "revisit", 3), (3, "response", None), (-9, "response", None), (None, "response", None), (-(2**63), "response", None)],
        key=repr,
    )
