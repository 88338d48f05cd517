"""WARC archives: one gzip member per record, and a reader that recovers what follows damage.

Equal payloads of at least ``REVISIT_BYTES`` are stored once: the page with the smallest id holds the
response, the others are revisit records that name it. Every record states the length and digest
of its full payload.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.files import attempt_name, open_input, open_output, prepare_tasks
from millrace.operators.joins import sized_join
from millrace.staging import qualified, stage

REVISIT_BYTES = 100
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
URN = "urn:page:"
VERSION = re.compile(rb"WARC/\d+\.\d+\r\n")
MEMBER = b"\x1f\x8b\x08"
_STEP = 1 << 16
_FILES = "partition int, number int, path string, records bigint, bytes bigint"
_READ = (
    "path string, offset bigint, length bigint, inner_offset bigint, inner_length bigint, reason string, record_type string, record_id string, "
    "target_uri string, refers_to string, payload_digest string, payload_bytes bigint, payload binary"
)


def record(page_id: int, url: str, date: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record. A revisit holds the HTTP head only."""
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head if refers_to is not None else head + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{URN}{page_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", re.sub(r"\s", "%20", url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{URN}{refers_to}>"), ("WARC-Profile", PROFILE)]
    named = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.0\r\n" + named.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def _writer(folder: str, date: str, file_bytes: int):
    def write(batches):
        import pyarrow as pa

        part, rows, file = TaskContext.get().partitionId(), [], None
        for batch in batches:
            for row in batch.to_pylist():
                if file is None or rows[-1]["bytes"] >= file_bytes:
                    if file is not None:
                        file.close()
                    path = attempt_name(folder, "pages", part, len(rows), ".warc.gz")
                    file = open_output(path)
                    rows.append({"partition": part, "number": len(rows), "path": path,
                                 "records": 0, "bytes": 0})
                data = member(record(row["page_id"], row["url"] or "", date,
                                     row["html"].encode(), row["digest"], row["first"]))
                file.write(data)
                rows[-1]["records"] += 1
                rows[-1]["bytes"] += len(data)
        if file is not None:
            file.close()
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                ("partition", pa.int32()), ("number", pa.int32()), ("path", pa.string()),
                ("records", pa.int64()), ("bytes", pa.int64())]))

    return write


def write_warc(
    pages: DataFrame, folder: str, *, date: str = "2020-01-01T00:00:00Z", file_bytes: int = 64 << 20
) -> DataFrame:
    """Archive (``page_id``, ``url``, ``html``); returns the table of files, which is on disk.

    Pages are written where they are read: only digests are grouped, and only repeated ones are joined
    back, by broadcast within a measured bound. Null pages have an empty payload, a null url is
    empty. Rows that repeat the smallest page id of a payload are all responses. A null page id is
    written as the smallest integer.
    """
    prepare_tasks(pages.sparkSession)
    whole = pages.select(
        F.coalesce(F.col("page_id").cast("bigint"), F.lit(-(1 << 63)).cast("bigint")).alias("page_id"),
        "url", F.coalesce("html", F.lit("")).alias("html"),
    ).withColumn("digest", F.sha2("html", 256))
    firsts = (
        whole.filter(F.octet_length("html") >= REVISIT_BYTES).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1").drop("_n")
    )
    marked = sized_join(whole, firsts, ["digest"], "left").withColumn(
        "first", F.when(F.col("first") != F.col("page_id"), F.col("first"))
    )
    place = qualified(pages.sparkSession, folder)
    files = marked.mapInArrow(_writer(place, date, file_bytes), _FILES)
    return stage(files, "warc-files")


@dataclass
class Gap:
    """Bytes that belong to no valid record. ``inner`` is the offset and length of a bad stretch in the
    inflated bytes of its member, which then is at ``begin``."""

    begin: int
    end: int
    reason: str
    inner: tuple[int, int] | None = None


@dataclass
class Found:
    """A valid record: its place in the file, its named fields and its block."""

    begin: int
    end: int
    fields: dict[str, str]
    block: bytes


class Damaged(ValueError):
    pass


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Fields, block and length of the record at ``at`` in ``data``; all checks must hold."""
    version = VERSION.match(data, at)
    if version is None:
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n", version.end() - 2)
    if end < 0:
        raise Damaged("fields do not end")
    fields = {}
    for line in data[version.end():end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if line and not colon:
            raise Damaged("line without a field")
        fields[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    try:
        length = int(fields["content-length"])
    except (KeyError, ValueError):
        raise Damaged("no content length") from None
    if not fields.get("warc-type") or not fields.get("warc-record-id"):
        raise Damaged("no type or no id")
    begin = end + 4
    block = data[begin:begin + length]
    if length < 0 or len(block) < length or data[begin + length:begin + length + 4] != b"\r\n\r\n":
        raise Damaged("block does not end where its length says")
    kind, _, digest = fields.get("warc-block-digest", "").partition(":")
    if kind == "sha256" and hashlib.sha256(block).hexdigest() != digest:
        raise Damaged("block digest fails")
    return fields, block, begin + length + 4 - at


def _inflate(file, at: int, size: int) -> tuple[bytes, int, str | None]:
    """The gzip member at a place, where it ends, and what is wrong with it. Length and checksum are
    tested; of a damaged member all that can be inflated is returned."""
    unpack, parts, place = zlib.decompressobj(31), [], at
    while not unpack.eof:
        file.seek(place)
        step = file.read(min(_STEP, size - place))
        if not step:
            return b"".join(parts), place, "member is cut off"
        before = unpack.copy()
        try:
            parts.append(unpack.decompress(step))
        except zlib.error as error:
            try:
                for k in range(len(step)):
                    parts.append(before.decompress(step[k:k + 1]))
            except zlib.error:
                pass
            return b"".join(parts), place + k, f"member fails: {error}"
        place += len(step)
    return b"".join(parts), place - len(unpack.unused_data), None


def _inflated_to(file, at: int, size: int, length: int) -> int:
    """Place in the file up to which a member must be read for its first ``length`` bytes."""
    unpack, place = zlib.decompressobj(31), at
    while length > 0:
        file.seek(place)
        step = file.read(min(_STEP, size - place))
        place += len(step)
        while step and length > 0:
            before = unpack.copy()
            try:
                length -= len(unpack.decompress(step, length))
                step = unpack.unconsumed_tail
            except zlib.error:
                for k in range(len(step)):
                    length -= len(before.decompress(step[k:k + 1]))
                    if length <= 0:
                        return place - len(step) + k + 1
    return place - len(step)


def _inside(data: bytes, at: int, end: int, error: str | None) -> tuple[list, int]:
    """Records and bad stretches in the inflated bytes of a member, and where its last record ends.

    Where a record fails, the search goes on at the next version line. In a member whose bytes are known
    to be wrong somewhere, only records count whose block digest is stated and holds; a record that
    is all of such a member does not, as the wrong bytes may be in its fields.
    """
    parts, inner, gap, last = [], 0, None, 0
    while inner < len(data):
        try:
            fields, block, length = parse(data, inner)
            if error and error.startswith("member fails") and not fields.get(
                    "warc-block-digest", "").startswith("sha256:"):
                raise Damaged("no digest in a member that fails")
        except Damaged as reason:
            gap = gap or (inner, str(reason))
            inner = data.find(b"WARC/", inner + 1)
            if inner < 0:
                break
            continue
        if gap:
            parts.append(Gap(at, end, gap[1], (gap[0], inner - gap[0])))
            gap = None
        parts.append(Found(at, end, fields, block))
        inner = last = inner + length
    if error and error.startswith("member fails") and len(parts) == 1 and last == len(data):
        return [], 0
    if gap or error:
        parts.append(Gap(at, end, error or gap[1], (last, len(data) - last)))
    return parts, last


def _find(file, marks: tuple[bytes, ...], at: int, size: int) -> int:
    """First place from ``at`` where one of the marks begins, or the end of the file."""
    keep = max(map(len, marks)) - 1
    while at < size:
        file.seek(at)
        data = file.read(min(1 << 20, size - at))
        places = [p for p in (data.find(m) for m in marks) if p >= 0]
        if places:
            return at + min(places)
        if at + len(data) >= size:
            return size
        at += len(data) - keep
    return size


def _plain(file, at: int, size: int) -> tuple[dict[str, str], bytes, int]:
    """The uncompressed record at a place. More is read while the record may only be cut off, but
    never past its stated length."""
    step = _STEP
    while True:
        file.seek(at)
        data = file.read(min(step, size - at))
        try:
            return parse(data)
        except Damaged:
            found = re.search(rb"\r\ncontent-length:\s*(\d+)\r\n", data[:_STEP], re.IGNORECASE)
            wanted = int(found[1]) + 2 * _STEP if found else 0
            if len(data) >= min(wanted, size - at):
                raise
            step = wanted


def salvage(file, size: int):
    """Records and gaps of an archive, in order; together they cover all its bytes.

    A member or plain record that fails a check begins a gap. The search goes on for the next member
    or version line at which a valid record begins, and the gap ends there. A member that holds a
    valid record is searched inside: its records and bad stretches all have the place of the member,
    which ends where the next valid record begins if it is itself damaged.
    """
    at, gap, held = 0, None, []
    while at < size:
        file.seek(at)
        lead = file.read(5)
        resume = None
        try:
            if lead[:3] == MEMBER:
                data, end, error = _inflate(file, at, size)
                found, last = _inside(data, at, end, error)
                if not last:
                    raise Damaged(error or (found[0].reason if found else "empty member"))
                if error:
                    resume = max(at + 1, _inflated_to(file, at, size, last))
            elif lead == b"WARC/":
                fields, block, length = _plain(file, at, size)
                end = at + length
                found = [Found(at, end, fields, block)]
            else:
                raise Damaged("neither a member nor a version line")
        except Damaged as error:
            if not held:
                gap = gap or Gap(at, at, str(error))
            at = _find(file, (MEMBER, b"WARC/"), at + 1, size)
            continue
        for part in [gap] if gap else held:
            part.end = at
            yield part
        gap, held = None, []
        if resume is None:
            yield from found
            at = end
        else:
            held = found
            at = _find(file, (MEMBER, b"WARC/"), resume, size)
    for part in [gap] if gap else held:
        part.end = size
        yield part


def _payload(found: Found) -> tuple[bytes, int | None]:
    """Payload in the block, and the full length that the HTTP head states."""
    head, _, payload = found.block.partition(b"\r\n\r\n")
    stated = re.search(rb"(?:^|\r\n)content-length:\s*(\d+)", head, re.IGNORECASE)
    return payload, int(stated[1]) if stated else None


def _reader(batches):
    import pyarrow as pa

    schema = pa.schema([
        ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
        ("inner_offset", pa.int64()), ("inner_length", pa.int64()), ("reason", pa.string()),
        ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
        ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
        ("payload", pa.binary()),
    ])
    for batch in batches:
        for path in batch.column("path").to_pylist():
            rows, held = [], 0
            with open_input(path) as file:
                for found in salvage(file, file.size()):
                    row = {"path": path, "offset": found.begin, "length": found.end - found.begin}
                    if isinstance(found, Gap):
                        inner = found.inner or (None, None)
                        rows.append(row | {
                            "reason": found.reason, "inner_offset": inner[0], "inner_length": inner[1]})
                        continue
                    fields, (payload, stated) = found.fields, _payload(found)
                    revisit = fields.get("warc-type") == "revisit"
                    rows.append(row | {
                        "record_type": fields.get("warc-type"),
                        "record_id": fields.get("warc-record-id", "").strip("<>") or None,
                        "target_uri": fields.get("warc-target-uri"),
                        "refers_to": fields.get("warc-refers-to", "").strip("<>") or None,
                        "payload_digest": fields.get("warc-payload-digest", "").rpartition(":")[2]
                        if revisit else hashlib.sha256(payload).hexdigest(),
                        "payload_bytes": stated if revisit else len(payload),
                        "payload": None if revisit else payload,
                    })
                    held += len(payload)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)


def whole_records(records: DataFrame) -> DataFrame:
    """The records of :func:`read_warc`; the job fails at the first quarantined gap, so that a damaged
    archive cannot pass for a smaller one. Gaps are kept by using the rows of ``read_warc`` themselves."""
    gap = F.concat(F.lit("quarantined bytes in "), "path", F.lit(" at "), F.col("offset").cast("string"),
                   F.lit(": "), "reason")
    return records.filter(F.when(F.col("reason").isNull(), True).otherwise(F.raise_error(gap).cast("boolean")))


def read_warc(files: DataFrame) -> DataFrame:
    """Records and quarantined gaps of the archives named in ``path``.

    A row with a ``reason`` is a gap, from ``offset`` over ``length`` bytes; the others are records. A
    gap inside a member that holds valid records has its place in the inflated bytes, too.
    Digest and length are those of the full payload: computed from responses, stated by revisits.
    One task reads an archive, a member at a time; a member is held whole. No files give no rows;
    other columns are not read.
    """
    prepare_tasks(files.sparkSession)
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path").repartition(parts, "path").mapInArrow(_reader, _READ)
