"""Token ids in length-delimited binary records with a separate offset index.

A record is ``u64 length, u32 masked checksum of the length bytes, payload, u32 masked checksum of
the payload``; a payload is ``i64 document, u32 number of ids`` and the ids as ``u16``, or as
``u32`` where the largest id needs it. The checksum is CRC-32; the mask rotates it by 15 bits and
adds a constant, so that checksums of data that hold checksums stay telling. The index beside each
file holds the ``u64`` offset of every record, so that a reader may take records in any order. All
numbers are little-endian.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.files import attempt_name, open_input, open_output, prepare_tasks
from millrace.llm.tokens import encoder
from millrace.staging import qualified, stage

_MASK_ADD = 0xA282EAD8
_HEAD = "<QI"
_PAYLOAD = "<qI"
_FILES = (
    "partition int, number int, path string, index string, first_id bigint, records bigint, "
    "tokens bigint, bytes bigint, width int"
)
_READ = "partition int, number int, place bigint, doc_id bigint, before bigint, ids binary"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK_ADD) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join(
        (length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload)))
    )


class Corrupt(ValueError):
    """A record whose checksum does not fit its bytes."""


def read_record(file, offset: int) -> tuple[bytes, int]:
    """Payload of the record at an offset, and the offset behind it."""
    file.seek(offset)
    head = file.read(struct.calcsize(_HEAD))
    if len(head) < struct.calcsize(_HEAD):
        raise Corrupt(f"record at {offset} is cut off")
    length, check = struct.unpack(_HEAD, head)
    if masked(head[:8]) != check:
        raise Corrupt(f"length at {offset} fails its checksum")
    payload, tail = file.read(length), file.read(4)
    if len(payload) < length or len(tail) < 4 or masked(payload) != struct.unpack("<I", tail)[0]:
        raise Corrupt(f"payload at {offset} fails its checksum")
    return payload, offset + len(head) + length + 4


# Records wait for one write of at least so many bytes.
_WRITE_BYTES = 1 << 20


def _writer(folder: str, tokenizer: str, end_id: int, file_bytes: int):
    def write(batches):
        import pyarrow as pa

        encode = encoder(tokenizer)
        largest = max(end_id, encode.library.get_vocab_size(with_added_tokens=True) - 1)
        width = 2 if largest < 1 << 16 else 4
        kind, end = f"<u{width}", np.array([end_id], dtype="<u4").tobytes()
        part, rows, out = TaskContext.get().partitionId(), [], None

        def settle():
            out["file"].write(b"".join(out["held"]))
            out["held"], out["written"] = [], out["at"]

        def close():
            nonlocal out
            if out is not None:
                settle()
                out["file"].close()
                with open_output(out["row"]["index"]) as index:
                    index.write(np.array(out["offsets"], dtype="<u8").tobytes())
                rows.append(out["row"] | {"bytes": out["at"], "records": len(out["offsets"])})
                out = None

        for batch, texts in encode.encode_batches(batches):
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), texts):
                ids = np.frombuffer(raw + end, dtype="<u4")
                if out is None or out["at"] >= file_bytes:
                    close()
                    path = attempt_name(folder, "records", part, len(rows), ".bin")
                    out = {"file": open_output(path), "at": 0, "written": 0, "held": [], "offsets": [], "row": {
                        "partition": part, "number": len(rows), "path": path,
                        "index": f"{path}.idx", "first_id": doc_id, "tokens": 0, "width": width}}
                record = frame(struct.pack(_PAYLOAD, doc_id, len(ids)) + ids.astype(kind).tobytes())
                out["offsets"].append(out["at"])
                out["held"].append(record)
                out["at"] += len(record)
                if out["at"] - out["written"] >= _WRITE_BYTES:
                    settle()
                out["row"]["tokens"] += len(ids)
        close()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                ("partition", pa.int32()), ("number", pa.int32()), ("path", pa.string()),
                ("index", pa.string()), ("first_id", pa.int64()), ("records", pa.int64()),
                ("tokens", pa.int64()), ("bytes", pa.int64()), ("width", pa.int32())]))

    return write


def write_records(
    docs: DataFrame, folder: str, tokenizer: str, *, end_id: int = 0, file_bytes: int = 128 << 20
) -> DataFrame:
    """Write ``text`` of (``doc_id``, ``text``) in ascending order of ids; returns the table of files.

    Texts are ranged by id (by digest among equal ids) and encoded by the tasks that write, so ids
    are never shuffled. Files of a later partition hold larger ids. Null texts count as empty; a
    null id is written as the smallest integer. The returned table is on disk: reading it again
    writes nothing.
    """
    prepare_tasks(docs.sparkSession)
    ranged = docs.select(
        F.coalesce("doc_id", F.lit(-(1 << 63)).cast("bigint")).alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("_tie", F.xxhash64("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = ranged.repartitionByRange(parts, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    files = ordered.select("doc_id", "text").mapInArrow(
        _writer(qualified(docs.sparkSession, folder), tokenizer, end_id, file_bytes), _FILES
    )
    return stage(files, "record-files")


def _read(rows):
    """All records of the named files, in the order of the index; each checksum is tested."""
    import pyarrow as pa

    names = ["partition", "number", "place", "doc_id", "before", "ids"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    for batch in rows:
        for row in batch.to_pylist():
            with open_input(row["index"]) as index:
                offsets = np.frombuffer(index.read(), dtype="<u8").tolist()
            with open_input(row["path"]) as file:
                out, held, before = [], 0, 0
                for place, offset in enumerate(offsets):
                    payload, _ = read_record(file, offset)
                    doc_id, n = struct.unpack_from(_PAYLOAD, payload)
                    ids = np.frombuffer(payload, dtype=f"<u{row['width']}", offset=struct.calcsize(_PAYLOAD))
                    if len(ids) != n:
                        raise Corrupt(f"{row['path']} at {offset}: {len(ids)} ids, not {n}")
                    out.append((row["partition"], row["number"], place, doc_id, before,
                                ids.astype("<u4").tobytes()))
                    before, held = before + n, held + 4 * n
                    if held > 4 << 20:
                        yield _batch(out, names, kinds)
                        out, held = [], 0
                if out:
                    yield _batch(out, names, kinds)


def _batch(rows, names, kinds):
    import pyarrow as pa

    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, names)


def read_records(files: DataFrame) -> DataFrame:
    """One row per record: ``doc_id``, ``start`` (ids of all records before it), ``ids`` (binary).

    One task reads a file, of bounded size. The starts come from the ids per file, one row each.
    """
    prepare_tasks(files.sparkSession)
    order = Window.orderBy("partition", "number").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select(
        "partition", "number", F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("_base")
    )
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    records = files.repartition(parts, "partition", "number").mapInArrow(_read, _READ)
    return records.join(F.broadcast(starts), ["partition", "number"]).select(
        F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")).alias("doc_id"),
        (F.col("_base") + F.col("before")).alias("start"), "ids",
    )
