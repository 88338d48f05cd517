"""Packing by vector bin packing with the dot-product heuristic.

A sequence has limits on tokens, on segments and on loss-bearing tokens. An example is a vector
of the same three quantities. The open sequence takes, of the waiting examples that fit, the one
whose vector has the largest dot product with what is left of the limits (both as shares of the
limits): large examples first, and those that use what is plentiful. When none fits and much
room is left, the example with the largest product is cut to fill it; else the sequence is closed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.files import prepare_tasks
from millrace.llm.tokens import MEMO_CHUNKS, encoder

PIECES = (
    "doc_id bigint, start bigint, length bigint, doc_tokens bigint, loss_tokens bigint, "
    "sequence_id bigint, offset bigint, ids binary"
)


@dataclass(frozen=True)
class Limits:
    """Limits of a sequence; ``spare`` is the room that may stay empty without a cut, ``waiting``
    the number of examples among which the heuristic chooses. Examples without a known prompt bear no
    loss on the leading ``prompt_share`` of their ids."""

    tokens: int = 2048
    segments: int = 256
    loss_tokens: int = 2048
    spare: int = 16
    waiting: int = 512
    prompt_share: float = 0.0


# Documents have no marked prompt: the leading eighth of each is taken as context. The limit on loss
# lies so little below the tokens that a sequence of loss alone still has at most 32 ids of padding.
DOCUMENTS = Limits(loss_tokens=2016, prompt_share=1 / 8)


class Packer:
    """Places pieces of examples; ``emit(key, start, length, doc_tokens, loss, sequence, offset, ids)``."""

    def __init__(self, limits: Limits, emit, first_sequence: int = 0):
        self.limits, self.emit, self.sequence = limits, emit, first_sequence
        self.caps = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=np.float64)
        self.sizes = np.zeros((limits.waiting, 3))
        self.shares = np.zeros((limits.waiting, 3))
        self.items: list = [None] * limits.waiting
        self.free = list(range(limits.waiting - 1, -1, -1))
        self.left = self.caps.copy()
        self.offset = 0

    def add(self, key, ids: np.ndarray, prompt: int = 0) -> None:
        """Add an example whose first ``prompt`` ids bear no loss. One longer than a sequence is cut
        into whole sequences, and its rest waits."""
        total, start = len(ids), 0
        while total - start > 0:
            if not self.free:
                self._place()
                continue
            take = min(total - start, self.limits.tokens)
            loss = max(0, start + take - max(start, prompt))
            if loss > self.limits.loss_tokens:
                take -= loss - self.limits.loss_tokens
                loss = self.limits.loss_tokens
            slot = self.free.pop()
            self.items[slot] = (key, start, ids[start:start + take], total, loss)
            self._size(slot, (take, 1, loss))
            start += take

    def finish(self) -> None:
        while len(self.free) < self.limits.waiting:
            self._place()
        if self.offset:
            self._close()

    def _size(self, slot: int, size: tuple) -> None:
        self.sizes[slot] = size
        self.shares[slot] = self.sizes[slot] / self.caps

    def _close(self) -> None:
        self.sequence += 1
        self.offset, self.left = 0, self.caps.copy()

    def _place(self) -> None:
        """Place one waiting example, or a cut of it, or close the sequence."""
        used = self.sizes[:, 1] > 0
        fits = used.copy()
        for column, left in zip(self.sizes.T, self.left):
            fits &= column <= left
        products = self.shares @ (self.left / self.caps)
        if fits.any():
            self._put(int(np.where(fits, products, -1.0).argmax()), None)
        elif self.left[1] >= 1 and min(self.left[0], self.left[2]) > self.limits.spare:
            self._put(int(np.where(used, products, -1.0).argmax()), int(self.left[0]))
        else:
            self._close()

    def _put(self, slot: int, room: int | None) -> None:
        key, start, ids, total, loss = self.items[slot]
        length, bearing = len(ids), loss
        if room is not None:
            silent = len(ids) - loss
            length = int(min(len(ids), room, silent + self.left[2]))
            bearing = max(0, length - silent)
        self.emit(key, start, length, total, bearing, self.sequence, self.offset, ids[:length])
        self.offset += length
        self.left -= (length, 1, bearing)
        if length == len(ids):
            self.items[slot] = None
            self._size(slot, (0, 0, 0))
            self.free.append(slot)
        else:
            rest = ids[length:]
            self.items[slot] = (key, start + length, rest, total, loss - bearing)
            self._size(slot, (len(rest), 1, loss - bearing))
        if self.left[0] <= 0 or self.left[1] <= 0:
            self._close()


def _packer(tokenizer: str, end_id: int, limits: Limits, memo_chunks: int):
    def pack(batches):
        import pyarrow as pa

        schema = pa.schema([(n, pa.int64()) for n in (
            "doc_id", "start", "length", "doc_tokens", "loss_tokens", "sequence_id", "offset"
        )] + [("ids", pa.binary())])
        rows, held = [], 0

        def emit(key, start, length, total, loss, sequence, offset, ids):
            nonlocal held
            rows.append((key, start, length, total, loss, sequence, offset, ids.tobytes()))
            held += 4 * length + 64

        def flush():
            nonlocal rows, held
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
            rows, held = [], 0
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        end = np.array([end_id], dtype="<u4").tobytes()
        packer = Packer(limits, emit, TaskContext.get().partitionId() << 36)
        for batch, texts in encoder(tokenizer, memo_chunks).encode_batches(batches):
            keys, prompts = (batch.column(c).to_pylist() for c in ("doc_id", "prompt"))
            for key, raw, prompt in zip(keys, texts, prompts):
                ids = np.frombuffer(raw + end, dtype="<u4")
                packer.add(key, ids, int(limits.prompt_share * len(ids)) if prompt is None else prompt)
                if held > 4 << 20:
                    yield flush()
        packer.finish()
        if rows:
            yield flush()

    return pack


def pack_texts(
    docs: DataFrame, tokenizer: str, limits: Limits = Limits(), *, end_id: int = 1,
    prompt: str | None = None, memo_chunks: int = MEMO_CHUNKS,
) -> DataFrame:
    """Pieces of all texts of (``doc_id``, ``text``), with their place in sequences and their ids.

    Every task packs the rows it reads; nothing is shuffled, and a task holds one batch of rows and
    ``limits.waiting`` examples. ``prompt`` names a column with the number of leading ids of an example
    that bear no loss (instructions); where it is null or not given, ``limits.prompt_share`` says so. Null texts count as empty: their one
    id is the end id. ``memo_chunks`` bounds what the encoder of a worker remembers. Repeated rows are packed one by one; other columns are not read.
    """
    prepare_tasks(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        (F.col(prompt) if prompt else F.lit(None)).cast("bigint").alias("prompt"),
    )
    return rows.mapInArrow(_packer(tokenizer, end_id, limits, memo_chunks), PIECES)
