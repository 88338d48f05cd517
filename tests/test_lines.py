"""Command files read by byte ranges, against ``str.splitlines``."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.sources import lines

SYMBOLS = [b"a", b" ", b"\n", b"\r", b"\r\n", b"\x0c", b"\x1c", "\u0085".encode(), "\u2028".encode(), "é".encode()]
FILES = {
    "plain.sh": b"".join(b"echo %d\n" % i for i in range(90)),
    "cr.sh": b"".join(b"ls %d\r" % i for i in range(90)),
    "crlf.sh": b"".join(b"ps %d\r\n" % i for i in range(90)) + b"last",
    "separators.sh": "\u2028".join(f"é{i}" for i in range(90)).encode(),
    "latin.sh": b"a\n" * 70 + "café\u0085x\n".encode("latin-1") + b"b\n" * 70,
    "late.sh": "x\u0085y\n".encode() * 40 + b"\xff",
    "one_line.sh": b"w" * 1000,
    "blank.sh": b"\n" * 200,
    "short.sh": b"x\r\ny",
    "empty.sh": b"",
}


def wanted(raw):
    try:
        return raw.decode("utf-8").splitlines()
    except UnicodeDecodeError:
        return raw.decode("latin-1").splitlines()


def test_pieces(tmp_path, monkeypatch):
    rng, file = random.Random(5), tmp_path / "x"
    for _ in range(1500):
        pool = SYMBOLS if rng.random() < 0.7 else [b"a", b"\r", b"\x85", b"\xe9"]
        raw = b"".join(rng.choices(pool, k=rng.randint(0, 40)))
        file.write_bytes(raw)
        monkeypatch.setattr(lines, "_BLOCK_BYTES", rng.randint(1, 12))
        step = rng.randint(1, 20)
        encoding = "latin-1" if b"\x85" in pool else "utf-8"
        got = [
            line
            for begin in range(0, len(raw), step)
            for piece in lines.pieces(str(file).encode(), begin, min(begin + step, len(raw)))
            for line in piece.decode(encoding).splitlines()
        ]
        assert got == raw.decode(encoding).splitlines(), (raw, step)


@pytest.mark.parametrize("range_bytes", [64, 333, lines.RANGE_BYTES])
def test_read_lines(spark, tmp_path, range_bytes):
    for name, raw in FILES.items():
        (tmp_path / name).write_bytes(raw)
    rows = [(n % 2, name, str(tmp_path / name).encode(), len(raw)) for n, (name, raw) in enumerate(FILES.items())]
    rows += [(2, "plain.sh", rows[0][2], rows[0][3])]
    rows += [(0, name, str(tmp_path / name).encode(), size) for name, size in (("gone.sh", 5), ("lost.sh", 5000))]
    listed = spark.createDataFrame(rows, "source_ord int, relative_path string, file binary, size bigint")
    got = {}
    for row in lines.read_lines(listed, range_bytes=range_bytes).collect():
        got.setdefault((row.source_ord, row.path), []).append((row.line_no, row.line))
    want = {(o, name): list(enumerate(wanted(FILES[name]))) for o, name, _, _ in rows if FILES.get(name)}
    assert {key: sorted(held) for key, held in got.items()} == want


def test_no_files(spark):
    listed = spark.createDataFrame([], "source_ord int, relative_path string, file binary, size bigint")
    assert lines.read_lines(listed, range_bytes=1).count() == 0


def test_ranges_of_one_file_are_read_by_several_tasks(spark, tmp_path):
    raw = b"".join(b"make %d\n" % i for i in range(4000))
    (tmp_path / "big.sh").write_bytes(raw)
    listed = spark.createDataFrame(
        [(0, "big.sh", str(tmp_path / "big.sh").encode(), len(raw))],
        "source_ord int, relative_path string, file binary, size bigint")
    read = lines.read_lines(listed, range_bytes=1000)
    assert read.select(F.spark_partition_id()).distinct().count() > 1
    assert [r.line for r in read.orderBy("line_no").collect()] == wanted(raw)
