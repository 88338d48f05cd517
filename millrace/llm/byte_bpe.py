"""Byte-level BPE by overlapping chunks: pre-tokenise in parallel, stitch, encode, decode.

A text is matched from left to right by a pattern that looks ahead but never back, so what follows a
match depends on the place where the match ends and on nothing before it. A long text is therefore cut
into windows that overlap, and tasks match each window by itself. A window starts at any place, maybe
within a word, but soon its matches fall in step with those of the window before: the first place in
the overlap where both begin a match is where the one hands over to the other (the last few characters
of a window are not trusted, since the pattern could not look past them). Two windows that do not fall
in step, as in one endless word, are joined and matched again; in the end that is the whole text. The
pieces between two such places are encoded by the ranks, and the ids of a text are put together in order.

Short texts are one window, encoded where they are read. Only windows of long texts are shuffled.
Pre-tokens that a task has not met yet are merged many at once: each round joins the best pair of all.
"""

from __future__ import annotations

import base64
import heapq
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.files import prepare_tasks
from millrace.operators.joins import sized_join
from millrace.staging import stage

_LONG_PIECE = 96
_BLOCK = 1 << 15
_FEW_PIECES = 16
_TABLE_ROWS = 1 << 10
_GROUP_CHARS = 1 << 18


@dataclass(frozen=True)
class Vocabulary:
    """A file of ranks (a base64 token and its rank per line), the pattern of pre-tokens, and how many
    characters past the end of a match the pattern may look at. The pattern must not look behind."""

    path: str
    pattern: str
    looks_ahead: int = 4


@dataclass(frozen=True)
class Chunks:
    """Characters of a window before the next one begins, and characters that two windows share."""

    size: int = 1 << 15
    overlap: int = 1 << 9


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the neighbours of the lowest rank merge first, the leftmost of equals.

    Short pieces are searched anew for each merge. Long ones keep the candidates in a heap and the
    parts in a linked list, so that a piece of n bytes takes n log n steps.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) <= _LONG_PIECE:
        parts = [piece[k:k + 1] for k in range(len(piece))]
        while len(parts) > 1:
            found = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
            least = min(found)
            if least == 1 << 60:
                break
            at = found.index(least)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[part] for part in parts]
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # the next and the former part
    gone = bytearray(n)
    heap = [(rank, k, k + 2) for k in range(n - 1)
            if (rank := ranks.get(piece[k:k + 2])) is not None]
    heapq.heapify(heap)

    def offer(begin: int) -> None:
        middle = after[begin]
        if middle < n and (rank := ranks.get(piece[begin:after[middle]])) is not None:
            heapq.heappush(heap, (rank, begin, after[middle]))

    while heap:
        _, begin, end = heapq.heappop(heap)
        if gone[begin] or after[begin] >= n or after[after[begin]] != end:
            continue
        gone[after[begin]] = 1
        after[begin] = end
        if end < n:
            before[end] = begin
        offer(begin)
        if before[begin] >= 0:
            offer(before[begin])
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at:after[at]]])
        at = after[at]
    return ids


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


class Merger:
    """Merges many short pieces at once, each by the steps of ``merge``.

    A piece is a row of a table of symbols, with an end mark on either side. A symbol is the rank of its
    bytes; a single byte without a rank has a symbol above all ranks. Every round merges the leftmost of
    the lowest pairs of each row that still has one, and looks up its two new neighbours.
    """

    NONE = np.iinfo(np.int32).max

    def __init__(self, ranks: dict[bytes, int]):
        self.count = max(ranks.values()) + 1
        self.end = self.count + 256
        known = {bytes([b]): self.count + b for b in range(256)} | ranks
        self.symbols = np.array([known[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = known.get(token[:k]), known.get(token[k:])
                if left is not None and right is not None:
                    pairs[left * (self.end + 1) + right] = rank
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(np.fromiter(pairs.values(), np.int32, len(pairs))[order], self.NONE)
        both = np.append(self.symbols, self.end)
        self.byte_pairs = self.found(both[:, None], both[None, :])

    def found(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols; NONE if the two make no token."""
        wanted = left * (self.end + 1) + right
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.ranks[at], self.NONE)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers; a table holds pieces of like lengths."""
        order = sorted(range(len(pieces)), key=lambda k: len(pieces[k]))
        merged = [b""] * len(pieces)
        for begin in range(0, len(order), _TABLE_ROWS):
            some = order[begin:begin + _TABLE_ROWS]
            for at, ids in zip(some, self._table([pieces[k] for k in some])):
                merged[at] = ids
        return merged

    def _table(self, pieces: list[bytes]) -> list[bytes]:
        n = len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        columns = np.arange(lengths.max() + 2)
        width = len(columns)
        inside = (columns > 0) & (columns <= lengths[:, None])
        codes = np.full((n, width), 256, dtype=np.int64)
        codes[inside] = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        table = np.full((n, width), self.NONE, dtype=np.int32)
        table[:, :-1] = self.byte_pairs[codes[:, :-1], codes[:, 1:]]
        symbols = np.append(self.symbols, self.end)[codes].ravel()
        pairs, left, right = table.ravel(), np.arange(n * width) - 1, np.arange(n * width) + 1
        rows = np.arange(n)
        while len(rows):
            at = rows * width + table[rows].argmin(axis=1)
            least = pairs[at]
            going = least < self.NONE
            rows, at, least = rows[going], at[going], least[going].astype(np.int64)
            gone, before = right[at], left[at]
            after = right[gone]
            symbols[at], symbols[gone], pairs[gone] = least, -1, self.NONE
            right[at], left[after] = after, at
            pairs[at] = self.found(least, symbols[after])
            pairs[before] = self.found(symbols[before], least)
        kept = inside & (symbols.reshape(n, width) >= 0)
        ids = symbols.reshape(n, width)[kept]
        if (ids >= self.count).any():
            raise KeyError("a byte without a rank")
        raw, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(kept.sum(axis=1))).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]


class Coder:
    """Matches, encodes and decodes. The ids of at most ``memo_pieces`` short pieces are kept."""

    def __init__(self, vocabulary: Vocabulary, memo_pieces: int = 500_000):
        import regex

        self.ranks = read_ranks(vocabulary.path)
        self.pattern = regex.compile(vocabulary.pattern)
        self.memo: dict[str, bytes] = {}
        self.memo_pieces = memo_pieces
        count = max(self.ranks.values()) + 1
        words = [b""] * count
        for token, rank in self.ranks.items():
            words[rank] = token
        self.widths = np.array([len(w) for w in words], dtype=np.int64)
        self.places = np.concatenate([[0], np.cumsum(self.widths)])
        self.bytes = np.frombuffer(b"".join(words), dtype=np.uint8)

    @cached_property
    def merger(self) -> Merger:
        return Merger(self.ranks)

    def starts(self, text: str) -> list[int]:
        """Places in a text where pre-tokens begin."""
        return [match.start() for match in self.pattern.finditer(text)]

    def encode_pieces(self, pieces: list[str]) -> bytes:
        """Ids of pre-tokens as little-endian unsigned 32-bit integers."""
        return self.encode_lists([pieces])[0]

    def encode_lists(self, lists: list[list[str]]) -> list[bytes]:
        """The same for each list; what none of them has met before is merged together."""
        if len(self.memo) > self.memo_pieces:
            self.memo = {}
        memo, long, short = self.memo, [], []
        for piece in set().union(*lists).difference(memo):
            raw = piece.encode()
            rank = self.ranks.get(raw)
            if rank is None and len(raw) <= _LONG_PIECE:
                short.append((piece, raw))
            else:
                memo[piece] = _packed([rank] if rank is not None else merge(raw, self.ranks))
            if len(piece) > _LONG_PIECE:
                long.append(piece)
        if len(short) < _FEW_PIECES:
            memo.update((piece, _packed(merge(raw, self.ranks))) for piece, raw in short)
        else:
            memo.update(zip([piece for piece, _ in short], self.merger.merge([raw for _, raw in short])))
        ids = [b"".join(map(memo.__getitem__, pieces)) for pieces in lists]
        for piece in long:
            del memo[piece]
        return ids

    def encode_each(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; texts of a bounded number of characters are encoded together."""
        found, held, size = [], [], 0
        for text in texts:
            if size + len(text) > _GROUP_CHARS:
                found += self.encode_lists(held)
                held, size = [], 0
            if len(text) > _GROUP_CHARS:
                found.append(self.encode(text))
                continue
            held.append(self.pattern.findall(text))
            size += len(text)
        return found + self.encode_lists(held)

    def encode(self, text: str) -> bytes:
        if len(text) <= _BLOCK:
            return self.encode_pieces(self.pattern.findall(text))
        found, held = [], []
        for match in self.pattern.finditer(text):
            held.append(match.group())
            if len(held) >= _BLOCK:
                found.append(self.encode_pieces(held))
                held = []
        return b"".join([*found, self.encode_pieces(held)])

    def decode(self, ids: bytes) -> bytes:
        """Raw bytes of ids, one after another."""
        found = []
        for begin in range(0, len(ids), 4 * _BLOCK):
            part = np.frombuffer(ids[begin:begin + 4 * _BLOCK], dtype="<u4").astype(np.int64)
            widths = self.widths[part]
            ends = np.cumsum(widths)
            shift = np.repeat(self.places[part] - (ends - widths), widths)
            found.append(self.bytes[shift + np.arange(len(shift))].tobytes())
        return b"".join(found)


@lru_cache(maxsize=2)
def coder(vocabulary: Vocabulary) -> Coder:
    """One coder per Python worker and vocabulary."""
    return Coder(vocabulary)


def _whole_texts(vocabulary: Vocabulary):
    def encode(batches):
        import pyarrow as pa

        own = coder(vocabulary)
        for batch in batches:
            ids = own.encode_each(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return encode


WINDOWS = "text_no bigint, doc_id bigint, first int, span int, last boolean, window string"


def _windows(chunks: Chunks):
    """Windows of long texts. ``text_no`` tells rows apart, also those of one id."""
    def cut(batches):
        import pyarrow as pa

        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text, number = text.as_py(), number + 1
                count = max(1, -(-(len(text) - chunks.overlap) // chunks.size))
                for k in range(0, count, 16):
                    some = range(k, min(count, k + 16))
                    n = len(some)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([number] * n, pa.int64()), pa.array([doc_id] * n, pa.int64()),
                        pa.array(some, pa.int32()), pa.array([1] * n, pa.int32()),
                        pa.array([j == count - 1 for j in some], pa.bool_()),
                        pa.array([text[j * chunks.size:(len(text) if j == count - 1 else
                                                        (j + 1) * chunks.size + chunks.overlap)]
                                  for j in some], pa.string()),
                    ], ["text_no", "doc_id", "first", "span", "last", "window"])

    return cut


MATCHED = WINDOWS + ", starts array<int>, head array<int>, tail array<int>"


def _matched(vocabulary: Vocabulary, chunks: Chunks):
    """Adds where pre-tokens of a window begin: all, those in the overlap with the window before,
    and those that can be trusted in the overlap with the next (counted from the start of that)."""
    def match(batches):
        import pyarrow as pa

        own, lists = coder(vocabulary), pa.list_(pa.int32())
        for batch in batches:
            for row in batch.to_pylist():
                text, core = row["window"], row["span"] * chunks.size
                starts = own.starts(text)
                sure = len(text) - vocabulary.looks_ahead
                row["starts"] = starts
                row["head"] = [s for s in starts if s < chunks.overlap]
                row["tail"] = [] if row["last"] else [s - core for s in starts if core <= s <= sure]
                columns = {k: pa.array([row[k]], f.type) for k, f in zip(
                    batch.schema.names, batch.schema)}
                columns |= {k: pa.array([row[k]], lists) for k in ("starts", "head", "tail")}
                yield pa.RecordBatch.from_pydict(columns)

    return match


def _meeting_places(matched: DataFrame) -> DataFrame:
    """Per window (``text_no``, ``first``) the place ``begin`` where it takes over from the one before it.
    Null if the two do not fall in step; 0 for the first window of a text."""
    ends = matched.select("text_no", (F.col("first") + F.col("span")).alias("first"), "tail")
    met = matched.select("text_no", "first", "head").join(ends, ["text_no", "first"], "left")
    return met.select("text_no", "first", F.when(F.col("first") == 0, 0).otherwise(
        F.array_min(F.array_intersect("head", "tail"))).alias("begin"))


def _joined(matched: DataFrame, places: DataFrame, chunks: Chunks) -> DataFrame:
    """All windows; those that are out of step are joined with the one before them. The runs of a text
    are found on narrow rows; a group holds the windows of one run."""
    runs = Window.partitionBy("text_no").orderBy("first")
    numbered = places.withColumn("run", F.sum(
        F.when(F.col("begin").isNull(), 0).otherwise(1)).over(runs))
    own = F.when(F.col("last"), F.col("window")).otherwise(
        F.substr("window", F.lit(1), F.col("span") * chunks.size))
    grouped = sized_join(matched, numbered.select("text_no", "first", "run"), ["text_no", "first"])
    return grouped.groupBy("text_no", "doc_id", "run").agg(
        F.min("first").alias("first"), F.sum("span").cast("int").alias("span"),
        F.max("last").alias("last"),
        F.sort_array(F.collect_list(F.struct("first", own.alias("own"), F.substr(
            "window", F.col("span") * chunks.size + 1).alias("rest"), "last"))).alias("_w"),
    ).select("text_no", "doc_id", "first", "span", "last", F.concat(
        F.array_join(F.transform("_w", lambda w: w["own"]), ""),
        F.when(F.col("last"), "").otherwise(F.element_at("_w", -1)["rest"]),
    ).alias("window"))


def _pieces(vocabulary: Vocabulary):
    """Encodes the pre-tokens from ``begin`` up to ``until`` of each window."""
    def encode(batches):
        import pyarrow as pa

        own = coder(vocabulary)
        for batch in batches:
            for row in batch.to_pylist():
                text = row["window"]
                until = len(text) if row["until"] is None else row["until"]
                cuts = [s for s in row["starts"] if row["begin"] <= s < until] + [until]
                parts = []
                for k in range(0, len(cuts) - 1, _BLOCK):
                    some = cuts[k:k + _BLOCK + 1]
                    parts.append(own.encode_pieces(
                        [text[a:b] for a, b in zip(some, some[1:])]))
                yield pa.RecordBatch.from_pydict({
                    "text_no": pa.array([row["text_no"]], pa.int64()),
                    "doc_id": pa.array([row["doc_id"]], pa.int64()),
                    "first": pa.array([row["first"]], pa.int32()),
                    "ids": pa.array([b"".join(parts)], pa.binary()),
                })

    return encode


def _encode_long(long: DataFrame, vocabulary: Vocabulary, chunks: Chunks) -> DataFrame:
    # written first: a number of a text must not change when a lost task runs again
    cut = stage(long.mapInArrow(_windows(chunks), WINDOWS), "windows")
    windows = cut.repartition("text_no", "first")
    while True:
        matched = stage(windows.mapInArrow(_matched(vocabulary, chunks), MATCHED), "matched")
        places = stage(_meeting_places(matched), "meeting-places")
        if places.filter("begin IS NULL").isEmpty():
            break
        windows = stage(_joined(matched, places, chunks), "joined-windows")
    following = Window.partitionBy("text_no").orderBy("first")
    spans = sized_join(
        matched.drop("head", "tail"),
        places.withColumn("_next", F.lead("begin").over(following)), ["text_no", "first"],
    ).withColumn("until", F.col("_next") + F.col("span") * chunks.size)
    encoded = spans.select("text_no", "doc_id", "first", "starts", "begin", "until", "window").mapInArrow(
        _pieces(vocabulary), "text_no bigint, doc_id bigint, first int, ids binary")
    return encoded.groupBy("text_no", "doc_id").agg(
        F.sort_array(F.collect_list(F.struct("first", "ids"))).alias("_w")
    ).select("doc_id", F.unhex(
        F.array_join(F.transform("_w", lambda w: F.hex(w["ids"])), "")).alias("ids"))


def encode_texts(
    docs: DataFrame, vocabulary: Vocabulary, chunks: Chunks = Chunks(), *,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit integers) of every row.

    Equal to matching the whole text and encoding each match, whatever the windows. Null and empty
    texts have no ids (an empty binary). Repeated rows and rows of one id are encoded one by one; null
    ids stay null; other columns are not read; an empty table gives none.
    """
    if not 0 < vocabulary.looks_ahead < chunks.overlap <= chunks.size:
        raise ValueError("an overlap must be larger than the look-ahead and at most a chunk")
    prepare_tasks(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    longer = F.char_length("text") > chunks.size + chunks.overlap
    short = rows.filter(~longer).mapInArrow(_whole_texts(vocabulary), "doc_id bigint, ids binary")
    return short.unionByName(_encode_long(rows.filter(longer), vocabulary, chunks))


def decode_texts(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The columns of ``encoded`` and ``decoded``, the raw bytes of its column ``ids``; null gives null."""
    prepare_tasks(encoded.sparkSession)

    def decode(batches):
        import pyarrow as pa

        own = coder(vocabulary)
        for batch in batches:
            raw = [None if ids is None else own.decode(ids) for ids in batch.column("ids").to_pylist()]
            kept = [n for n in batch.schema.names if n != "decoded"]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, kept), pa.array(raw, pa.binary())], [*kept, "decoded"])

    kept = encoded.drop("decoded")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", decoded binary"
    return kept.mapInArrow(decode, schema)
