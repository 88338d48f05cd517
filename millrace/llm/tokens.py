"""Token ids of whole texts by the tokenizers library, with a memo of word-sized chunks.

The byte-level pre-tokenizer never lets a token run from a non-space into white space, nor from a
letter into a mark or digit, so a text may be cut there and every piece encoded by itself. The cuts
are found in the bytes of many texts at once, and equal pieces among them are looked up once. The
memo keeps the library's ids of such pieces; only pieces that it does not hold reach the library.
Any other kind of tokenizer file gets whole texts.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

# Unicode's White_Space, which the byte-level pattern means by \s.
_SPACE = "\t-\r \x85\xa0  -     　"
# Letters in every version of Unicode, and the marks and digits of ASCII.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_MARKS = r"!-@\[-`{-~"
_CUT = re.compile(f"(?<=[^{_SPACE}])[{_SPACE}]|(?<=[{_LETTERS}])[{_MARKS}]")
_BLOCK = 1 << 16
# Texts wait until they hold so many characters.
_HELD = 1 << 21
# The library gets so many pieces at once.
_LEARNED = 1 << 12
_LONGEST = 64
MEMO_CHUNKS = 600_000
_JOINABLE = re.compile(f"[{_SPACE}]")
_WHITE = frozenset(filter(_JOINABLE.match, map(chr, range(1 << 14))))


def _cut_tables() -> tuple[bytes, np.ndarray]:
    """What a byte that begins a character is, and of which kind a character is whose last two bytes are
    given: bit 1 for a space that may be cut off and for no white space before it, bit 2 for a mark or
    digit and for a letter before it. Bytes in which white space may end count as white space."""
    stops, before = bytearray(1 << 8), np.ones((1 << 8, 1 << 8), dtype=np.uint8)
    for c in map(chr, range(1 << 7)):
        stops[ord(c)] = (c in _WHITE) + 2 * bool(re.match(f"[{_MARKS}]", c))
    for c in map(chr, range(1 << 14)):
        last = c.encode()[-2:]
        pair = (*last,) if len(last) == 2 else (slice(None), *last)
        if re.match(f"[{_LETTERS}]", c):
            before[pair] |= 2
        elif c in _WHITE:
            before[pair] = 0
    return bytes(stops), before.reshape(-1)


_STOPS, _BEFORE = _cut_tables()


class Encoder:
    """Encodes texts without added special tokens; special strings in texts are handled as the
    library does by default. Two generations of at most ``memo_chunks`` pieces form the memo: a full
    one becomes the older, whose pieces move up when they are met again."""

    def __init__(self, path: str, memo_chunks: int = MEMO_CHUNKS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.memo_chunks = memo_chunks
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre, added = spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
        self.chunked = (
            spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]
                        or _JOINABLE.search(t["content"]) for t in added)
        )
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.names = names
        if self.chunked:
            vocabulary = self.library.get_vocab(with_added_tokens=True)
            self.widths = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
            for token, number in vocabulary.items():
                self.widths[number] = len(token)

    def _encode(self, text: str) -> list[int]:
        """Ids by the library, which need not say where they lie in the text."""
        return self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _library(self, text: str) -> bytes:
        return np.array(self._encode(text), dtype="<u4").tobytes()

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks by the library. Chunks that end without white space are encoded in one call,
        with a line feed before those that begin without; the bytes that each id stands for tell where
        chunks end."""
        joined = [c for c in chunks if c[-1] not in _WHITE]
        found = {}
        if joined:
            bare = [c[0] not in _WHITE for c in joined]
            ids = np.array(
                self._encode("".join(f"\n{c}" if b else c for b, c in zip(bare, joined))), dtype="<u4"
            )
            ends = np.cumsum(self.widths[ids])
            sizes = np.array([len(c.encode()) for c in joined]) + bare
            wanted = np.cumsum(sizes)
            begins = wanted - sizes + bare
            # The first id of a chunk, and the one behind its last.
            first, stops = np.searchsorted(ends, begins, "right"), np.searchsorted(ends, wanted) + 1
            edges = np.concatenate(([0], ends))
            if ends[-1] == wanted[-1] and (edges[first] == begins).all() and (edges[stops] == wanted).all():
                raw = ids.tobytes()
                for chunk, begin, stop in zip(joined, first.tolist(), stops.tolist()):
                    found[chunk] = raw[4 * begin:4 * stop]
        for chunk in chunks:
            if chunk not in found:
                found[chunk] = self._library(chunk)
        return found

    def _blocks(self, text: str):
        begin = 0
        while len(text) - begin > _BLOCK:
            cut = _CUT.search(text, begin + _BLOCK)
            if cut is None:
                break
            yield text[begin:cut.start()]
            begin = cut.start()
        yield text[begin:]

    def _lookup(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces; what the memo lacks of them is learned in calls of bounded size."""
        found = list(map(self.memo.get, pieces))
        missing = [k for k, ids in enumerate(found) if ids is None]
        for begin in range(0, len(missing), _LEARNED):
            if len(self.memo) > self.memo_chunks:
                self.memo, self.older = {}, self.memo
            some = missing[begin:begin + _LEARNED]
            new = {pieces[k]: self.older.get(pieces[k]) for k in some}
            new |= self._learn([piece for piece, ids in new.items() if ids is None])
            for k in some:
                found[k] = new[pieces[k]]
            self.memo.update((piece, ids) for piece, ids in new.items() if len(piece) <= _LONGEST)
        return found

    def _ids(self, parts: list[str], whole: list[int]) -> list[bytes]:
        """Ids of parts of texts, which are cut into pieces but for those at the places ``whole``."""
        import pyarrow as pa

        utf8 = [part.encode() for part in parts]
        raw = b"".join(utf8)
        data, stops = (np.frombuffer(b, dtype=np.uint8) for b in (raw, raw.translate(_STOPS)))
        begins = np.cumsum([0, *map(len, utf8)])
        at = np.flatnonzero(stops)
        at = at[at > 0]
        # Behind a first character of one byte this looks at the last byte, which decides nothing.
        pair = data[at - 2].astype(np.uint16) << 8 | data[at - 1]
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[at[(stops[at] & _BEFORE[pair]) > 0]] = True
        for k in whole:
            cut[begins[k]:begins[k + 1]] = False
        cut[begins] = True
        bounds = np.flatnonzero(cut)
        pieces = pa.LargeStringArray.from_buffers(
            len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(raw)
        ).dictionary_encode()
        known = self._lookup(pieces.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(known), dtype="<u4")
        sizes = np.array([len(ids) // 4 for ids in known])
        index = pieces.indices.to_numpy()
        lengths = sizes[index]
        ends = np.cumsum(lengths)
        places = np.repeat((np.cumsum(sizes) - sizes)[index] - (ends - lengths), lengths)
        places += np.arange(len(places))
        ids = flat[places]
        edges = np.concatenate(([0], ends))[np.searchsorted(bounds, begins)].tolist()
        return [ids[a:b].tobytes() for a, b in zip(edges, edges[1:])]

    def _parts(self, text: str):
        """Parts of a text of bounded size, and whether each is a special string, which is not cut."""
        pieces = [text]
        if self.special is not None and any(name in text for name in self.names):
            pieces = self.special.split(text)
        for k, piece in enumerate(pieces):
            if k % 2:
                yield piece, True
            elif piece:
                yield from ((block, False) for block in self._blocks(piece))

    def encode_many(self, texts) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers. Null counts as empty."""
        if not self.chunked:
            return [self._library(text) if text else b"" for text in texts]
        found: list[list[bytes]] = []
        parts, owners, whole, held = [], [], [], 0

        def settle():
            nonlocal parts, owners, whole, held
            if parts:
                for owner, ids in zip(owners, self._ids(parts, whole)):
                    found[owner].append(ids)
            parts, owners, whole, held = [], [], [], 0

        for text in texts:
            found.append([])
            for part, special in self._parts(text) if text else ():
                if special:
                    whole.append(len(parts))
                parts.append(part)
                owners.append(len(found) - 1)
                held += len(part)
                if held > _HELD:
                    settle()
        settle()
        return [ids[0] if len(ids) == 1 else b"".join(ids) for ids in found]

    def encode(self, text: str | None) -> bytes:
        return self.encode_many([text])[0]

    def encode_batches(self, batches):
        """Arrow batches, each with the ids of its column ``text``. Batches of few bytes are encoded
        together, so that their equal pieces are looked up once."""
        waiting, held = [], 0

        def settle():
            nonlocal waiting, held
            ids = self.encode_many(text.as_py() for batch in waiting for text in batch.column("text"))
            begin = 0
            for batch in waiting:
                yield batch, ids[begin:begin + batch.num_rows]
                begin += batch.num_rows
            waiting, held = [], 0

        for batch in batches:
            waiting.append(batch)
            held += batch.column("text").nbytes
            if held >= _HELD:
                yield from settle()
        yield from settle()


@lru_cache(maxsize=2)
def encoder(path: str, memo_chunks: int = MEMO_CHUNKS) -> Encoder:
    """One encoder per Python worker, file and size of the memo. It stays with the worker: a remembered piece
    takes half a kilobyte, of which there may be twice ``memo_chunks``."""
    return Encoder(path, memo_chunks)
