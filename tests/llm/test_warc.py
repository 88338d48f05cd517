"""Archives: round trips, revisits and recovery after damage."""

import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import warc
from millrace.llm.queries import CHECKS, QUERIES
from millrace.llm.warc import Found, Gap, member, read_warc, record, salvage, whole_records, write_warc

SCHEMA = "page_id bigint, url string, html string, digest string, first int"


def make(k, payload):
    return record(k, f"http://h/{k}", "2020-01-01T00:00:00Z", payload, hashlib.sha256(payload).hexdigest(), None)


def payloads(n=12):
    draw = random.Random(4)
    return [bytes(draw.getrandbits(8) for _ in range(draw.choice([0, 5, 3000, 90_000]))) for _ in range(n)]


def scan(data):
    return list(salvage(io.BytesIO(data), len(data)))


def check_cover(parts, size):
    """Records and gaps cover every byte once."""
    at = 0
    for part in parts:
        assert part.begin == at
        at = part.end
    assert at == size


def test_whole_archives_in_both_forms():
    bodies = payloads()
    for pack in (member, bytes):
        data = b"".join(pack(make(k, p)) for k, p in enumerate(bodies))
        parts = scan(data)
        check_cover(parts, len(data))
        assert [warc._payload(p)[0] for p in parts] == bodies


def test_records_after_damage_are_recovered():
    bodies, draw = payloads(), random.Random(6)
    for pack in (member, bytes):
        packed = [pack(make(k, p)) for k, p in enumerate(bodies)]
        for hurt in range(len(packed)):
            broken = bytearray(packed[hurt])
            way = draw.choice(["flip", "cut", "junk"])
            if way == "flip":
                broken[len(broken) // 2 if pack is member else -6] ^= 0xFF
            elif way == "cut":
                broken = broken[:len(broken) // 2]
            else:
                broken = bytearray(b"junk\x1f\x8b\x08WARC/1.0\r\n" + bytes(broken[40:]))
            data = b"".join([*packed[:hurt], bytes(broken), *packed[hurt + 1:]])
            parts = scan(data)
            check_cover(parts, len(data))
            ids = [p.fields["warc-record-id"] for p in parts if isinstance(p, Found)]
            want = [f"<{warc.URN}{k}>" for k in range(len(packed)) if k != hurt]
            assert ids == want
            gap, = [p for p in parts if isinstance(p, Gap)]
            assert gap.end - gap.begin == len(broken) and gap.reason


def test_files_that_hold_no_record():
    assert scan(b"") == []
    for data in (b"\x00" * 3000, b"WARC/", member(b"not a record"), member(b"")):
        gap, = scan(data)
        assert (gap.begin, gap.end) == (0, len(data))


def test_member_with_two_records():
    data = member(make(1, b"a") + make(2, b"b"))
    assert [warc._payload(p)[0] for p in scan(data)] == [b"a", b"b"]


def found_ids(parts):
    return [int(p.fields["warc-record-id"].strip("<>").rpartition(":")[2]) for p in parts if isinstance(p, Found)]


def test_damage_inside_a_member_with_several_records():
    records = [make(k, p) for k, p in enumerate(payloads())]
    hurt = bytearray(records[5])
    hurt[-6] ^= 0xFF
    data = member(b"".join([*records[:5], bytes(hurt), *records[6:]])) + member(make(99, b"next"))
    parts = scan(data)
    assert found_ids(parts) == [k for k in range(len(records)) if k != 5] + [99]
    gap, = [p for p in parts if isinstance(p, Gap)]
    assert gap.inner == (sum(map(len, records[:5])), len(hurt)) and gap.begin == 0


def test_records_of_a_member_that_is_cut_off_or_fails():
    records = [make(k, p) for k, p in enumerate(payloads())]
    whole, after = member(b"".join(records)), member(make(99, b"next"))
    for broken in (whole[:-20], whole[:len(whole) * 2 // 3], whole[:-6] + b"\0\0" + whole[-4:]):
        for tail in (b"", after):
            ids = found_ids(parts := scan(broken + tail))
            first = [k for k in ids if k != 99]
            assert len(first) >= 4 and first == list(range(len(first)))
            assert (99 in ids) == bool(tail) and any(isinstance(p, Gap) for p in parts)
            assert parts[-1].end == len(broken + tail)


def test_pages_round_trip_with_revisits(spark, tmp_path):
    big, small = "x" * 100, "y" * 99
    rows = [(5, "u 5", big), (2, None, big), (9, "u9", big), (1, "u1", small), (3, "u3", small),
            (4, "u4", None), (6, "u6", ""), (7, "u7", "é" * 60), (8, "u8", "é" * 60),
            (2, None, big), (10, "u10", "z" * 3_000_000), (None, "n", "q" * 200)]
    pages = spark.createDataFrame([(*r, "d", 1) for r in rows], SCHEMA).repartition(3)
    files = write_warc(pages, f"file://{tmp_path}/w", file_bytes=200)
    got = read_warc(files)
    assert got.filter("reason IS NOT NULL").count() == 0
    found = sorted(
        (int(r.record_id.rpartition(":")[2]), r.payload_bytes, r.payload_digest, r.record_type,
         r.refers_to and int(r.refers_to.rpartition(":")[2])) for r in got.collect())
    first = {big: 2, "é" * 60: 7}
    want = []
    for k, _, html in rows:
        k, html = -(1 << 63) if k is None else k, html or ""
        raw, refers = html.encode(), first.get(html, k)
        want.append((k, len(raw), hashlib.sha256(raw).hexdigest(),
                     "response" if refers == k else "revisit", None if refers == k else refers))
    assert found == sorted(want, key=lambda w: w[:4])
    assert files.count() > 3
    none = write_warc(pages.limit(0), f"file://{tmp_path}/e")
    assert read_warc(none).count() == 0


def test_damaged_file_reports_its_gap(spark, tmp_path):
    pages = spark.range(20).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), F.sha2(F.col("id").cast("string"), 512).alias("html"))
    files = write_warc(pages.coalesce(1), f"file://{tmp_path}/w")
    path = files.first().path.removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    data[len(data) // 2:len(data) // 2 + 30] = bytes(30)
    open(path, "wb").write(data)
    got = read_warc(files).collect()
    gap, = [r for r in got if r.reason]
    assert len(got) in (19, 20) and 0 < gap.length < len(data) / 10 and gap.record_id is None
    with pytest.raises(Exception, match="quarantined bytes"):
        whole_records(read_warc(files)).collect()


def test_query_fails_on_a_damaged_archive_and_keeps_null_ids(spark, tmp_path, monkeypatch):
    from millrace.llm import queries

    rows = [(1, "u", "x" * 300), (2, None, "x" * 300), (None, "u", None), (4, "u", "")]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1).write.parquet(
        f"{tmp_path}/pages.parquet")
    got = sorted(map(tuple, QUERIES["op4_warc"](spark, str(tmp_path)).collect()), key=str)
    digest = [hashlib.sha256(b).hexdigest() for b in (b"x" * 300, b"")]
    assert got == sorted([
        (1, 300, digest[0], "response", None), (2, 300, digest[0], "revisit", 1),
        (None, 0, digest[1], "response", None), (4, 0, digest[1], "response", None)], key=str)

    def damaged(pages, folder):
        files = write_warc(pages, folder)
        path = files.first().path.removeprefix("file://")
        data = open(path, "rb").read()
        open(path, "wb").write(data[:40] + bytes(30) + data[70:])
        return files

    monkeypatch.setattr(queries, "write_warc", damaged)
    with pytest.raises(Exception, match="quarantined bytes"):
        QUERIES["op4_warc"](spark, str(tmp_path)).collect()
    assert "op4_warc" in CHECKS
