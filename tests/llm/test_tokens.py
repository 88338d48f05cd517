"""Token ids, counts, records and packing against the library itself."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import token_records
from millrace.llm.packing import DOCUMENTS, Limits, Packer, pack_texts
from millrace.llm.token_cache import cached_token_counts
from millrace.llm.tokens import Encoder, encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ALPHABET = list("ab é's'll 12\t\n\r\x0b\x0c\x1c\x1f\x85\xa0   　​﻿😀.,!") + [
    "  ", " the", "the,", "don't", "x'll've", "ÀÉ×÷ª", "abc123", "q!?", "<|endoftext|>", "<|end", "oftext|>", "\n\n", " 's", " ",
]
TEXTS = [None, "", " ", "a", "the same", "the same", "x" * 30_000, "word " * 20_000,
         "<|endoftext|>", "a<|endoftext|> b", "\n \n", "naïve café　漢字"]


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def decode(raw):
    return np.frombuffer(raw, dtype="<u4").tolist()


def test_chunks_give_the_ids_of_the_library():
    draw, encoder = random.Random(7), Encoder(PATH, memo_chunks=300)
    assert encoder.chunked
    for _ in range(4000):
        text = "".join(draw.choices(ALPHABET, k=draw.randint(0, 40)))
        assert decode(encoder.encode(text)) == ids(text), repr(text)
    for text in TEXTS:
        assert decode(encoder.encode(text)) == ids(text)


def test_long_texts_are_cut_only_where_tokens_end():
    draw, encoder = random.Random(8), Encoder(PATH)
    text = "".join(draw.choices(ALPHABET[:4] + [" the", "\n"], k=90_000))
    assert decode(encoder.encode(text)) == ids(text)


class CountingMemo(dict):
    looked = 0

    def get(self, key, default=None):
        self.looked += 1
        return super().get(key, default)

    def __getitem__(self, key):
        self.looked += 1
        return super().__getitem__(key)


def test_equal_pieces_of_many_texts_are_looked_up_once():
    texts, encoder = ["one two, three two"] * 500 + ["<|endoftext|>one\ttwo"], Encoder(PATH)
    encoder.memo = CountingMemo()
    for _ in range(2):
        assert [decode(raw) for raw in encoder.encode_many(texts)] == [ids(text) for text in texts]
    assert encoder.memo.looked <= 20


def test_new_pieces_reach_the_library_in_one_call():
    class Counting:
        calls = 0

        def __getattr__(self, name):
            Counting.calls += name.startswith("encode")
            return getattr(LIBRARY, name)

    texts, encoder = [f"w{k},x{k} 's{k}'ll -{k}\n({k}" for k in range(300)], Encoder(PATH)
    encoder.library = Counting()
    assert [decode(raw) for raw in encoder.encode_many(texts)] == [ids(text) for text in texts]
    assert Counting.calls == 1


def test_texts_of_one_or_two_characters():
    marks = [*ALPHABET, "é", "ß", "\U0001f000"]
    texts = [*marks, *(a + b for a in marks for b in marks)]
    assert [decode(raw) for raw in Encoder(PATH).encode_many(texts)] == [ids(text) for text in texts]
    for text in marks:
        assert decode(Encoder(PATH).encode(text)) == ids(text), repr(text)


@pytest.fixture
def docs(spark):
    rows = [(k, text, "extra") for k, text in enumerate(TEXTS)] + [(3, "a", "extra")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, digest string")


def test_counts_come_from_the_cache_when_it_has_them(spark, docs, tmp_path):
    cache = f"file://{tmp_path}/cache"
    want = sorted((k, len((t or "").encode()), len(ids(t))) for k, t in [*enumerate(TEXTS), (3, "a")])
    for _ in range(2):
        assert sorted(map(tuple, cached_token_counts(docs, PATH, cache).collect())) == want
    stored = len({t or "" for t in TEXTS})
    assert spark.read.parquet(cache).count() == stored
    more = docs.union(spark.createDataFrame([(99, "new", "")], docs.schema))
    assert cached_token_counts(more, PATH, cache).count() == len(want) + 1
    assert spark.read.parquet(cache).count() == stored + 1
    empty = cached_token_counts(docs.limit(0), PATH, f"file://{tmp_path}/none")
    assert empty.count() == 0


@pytest.mark.parametrize("limit", [None, 0])
def test_a_filled_cache_gets_the_new_texts_only(spark, tmp_path, limit):
    cache = f"file://{tmp_path}/cache"
    first = spark.createDataFrame([(k, f"text {k % 7}") for k in range(40)], "doc_id long, text string")
    cached_token_counts(first, PATH, cache).collect()
    rows = [*[(k, f"text {k % 9}") for k in range(60)], (None, None), (3, ""), (3, "text 8")]
    second = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = cached_token_counts(second, PATH, cache, limit=limit).collect()
    want = [(i, len((t or "").encode()), len(ids(t))) for i, t in rows]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    stored = spark.read.parquet(cache).select("digest").collect()
    assert len(stored) == 10 == len({bytes(r.digest) for r in stored}), "nothing is counted twice"


def test_records_round_trip_in_order_of_ids(spark, docs, tmp_path):
    files = token_records.write_records(docs, f"file://{tmp_path}/r", PATH, file_bytes=1000)
    got = token_records.read_records(files).orderBy("start").collect()
    texts = sorted([*enumerate(TEXTS), (3, "a")], key=lambda row: row[0])
    assert [row.doc_id for row in got] == [k for k, _ in texts]
    start = 0
    for row, (_, text) in zip(got, texts):
        assert row.start == start and decode(row.ids) == [*ids(text), 0]
        start += len(decode(row.ids))
    assert files.count() > 1
    assert token_records.read_records(
        token_records.write_records(docs.limit(0), f"file://{tmp_path}/e", PATH)).count() == 0


def test_small_batches_are_written_with_one_lookup_of_equal_pieces(tmp_path, monkeypatch):
    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(token_records, "TaskContext", Task)
    texts = [f"the same words, {k % 3}" for k in range(400)]
    table = pa.table({"doc_id": pa.array(range(400), pa.int64()), "text": texts})
    memo = CountingMemo()
    monkeypatch.setattr(encoder(PATH), "memo", memo)
    write = token_records._writer(f"file://{tmp_path}/r", PATH, 0, 1 << 20)
    (files,) = write(iter(table.to_batches(max_chunksize=10)))
    assert 0 < memo.looked <= 20
    rows = [row for batch in token_records._read([files]) for row in batch.to_pylist()]
    assert [(row["doc_id"], decode(row["ids"])) for row in rows] == [
        (k, [*ids(text), 0]) for k, text in enumerate(texts)]


def test_batches_keep_their_ids():
    texts = ["a b", None, "", "x" * 100, "longer words " * 200_000, "a b"] * 3
    batches = pa.table({"text": pa.array(texts)}).to_batches(max_chunksize=2)
    got = [(batch.num_rows, [decode(raw) for raw in raws])
           for batch, raws in encoder(PATH).encode_batches([*batches, batches[0][:0]])]
    assert [n for n, _ in got] == [2] * 9 + [0]
    assert sum((raws for _, raws in got), []) == [ids(text) for text in texts]
    assert list(encoder(PATH).encode_batches([])) == []


def test_index_allows_reads_in_any_order_and_damage_is_seen(spark, docs, tmp_path):
    files = token_records.write_records(docs.coalesce(1), f"file://{tmp_path}/r", PATH).collect()
    row = max(files, key=lambda f: f.records)
    offsets = np.fromfile(row["index"].removeprefix("file://"), dtype="<u8").tolist()
    path = row.path.removeprefix("file://")
    with open(path, "rb") as file:
        whole = [token_records.read_record(file, o)[0] for o in offsets]
        for place in reversed(range(len(offsets))):
            assert token_records.read_record(file, offsets[place])[0] == whole[place]
    data = bytearray(open(path, "rb").read())
    data[offsets[-1] + 14] ^= 1
    with open(path, "wb") as file:
        file.write(data)
    with open(path, "rb") as file, pytest.raises(token_records.Corrupt):
        token_records.read_record(file, offsets[-1])


def check_pieces(pieces, texts, end_id, limits):
    """Every id lies in one piece; sequences have no gaps and keep the limits."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for key, text in texts:
        want = [*ids(text), end_id]
        parts = sorted(by_doc[key], key=lambda p: p.start)
        assert sum((decode(p.ids) for p in parts), []) == want
        assert all(p.doc_tokens == len(want) for p in parts)
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p.offset)
        at = 0
        for p in parts:
            assert p.offset == at and p.length == len(p.ids) // 4 > 0
            at += p.length
        assert at <= limits.tokens and len(parts) <= limits.segments
        assert sum(p.loss_tokens for p in parts) <= limits.loss_tokens
    return by_sequence


def test_packing_keeps_every_id_once(spark, docs):
    texts = list(enumerate(TEXTS))
    distinct = docs.dropDuplicates(["doc_id"])
    for limits in (Limits(), Limits(tokens=64, segments=3, loss_tokens=64, waiting=4)):
        pieces = pack_texts(distinct, PATH, limits, end_id=1).collect()
        check_pieces(pieces, texts, 1, limits)
    assert pack_texts(docs.limit(0), PATH).count() == 0
    twice = pack_texts(docs.filter("doc_id = 3"), PATH).collect()
    assert [p.length for p in twice] == [2, 2]


def test_prompts_bear_no_loss(spark, docs):
    limits = Limits(tokens=128, segments=8, loss_tokens=40, waiting=16)
    rows = docs.dropDuplicates(["doc_id"]).withColumn("prompt", F.lit(5))
    pieces = pack_texts(rows, PATH, limits, prompt="prompt").collect()
    check_pieces(pieces, list(enumerate(TEXTS)), 1, limits)
    loss = defaultdict(int)
    for p in pieces:
        loss[p.doc_id] += p.loss_tokens
    assert loss == {k: max(0, len(ids(t)) + 1 - 5) for k, t in enumerate(TEXTS)}


def plain_packing(examples, limits):
    """The dot-product rule on plain numbers: (key, start, length, sequence, offset, loss) in order."""
    caps = (limits.tokens, limits.segments, limits.loss_tokens)
    slots, free, placed = {}, list(range(limits.waiting))[::-1], []
    left, sequence, offset = list(caps), 0, 0

    def place():
        nonlocal left, sequence, offset
        def product(at):
            return sum((v / c) * (r / c) for v, c, r in zip(size(at), caps, left))
        def size(at):
            _, _, length, silent = slots[at]
            return length, 1, length - silent
        fits = [at for at in sorted(slots) if all(v <= r for v, r in zip(size(at), left))]
        if fits:
            at, room = max(fits, key=lambda a: (round(product(a), 12), -a)), None
        elif left[1] >= 1 and min(left[0], left[2]) > limits.spare:
            at, room = max(sorted(slots), key=lambda a: (round(product(a), 12), -a)), left[0]
        else:
            left, sequence, offset = list(caps), sequence + 1, 0
            return
        key, start, length, silent = slots[at]
        take = length if room is None else min(length, room, silent + left[2])
        loss = max(0, take - silent)
        placed.append((key, start, take, sequence, offset, loss))
        offset += take
        left = [left[0] - take, left[1] - 1, left[2] - loss]
        if take == length:
            del slots[at]
            free.append(at)
        else:
            slots[at] = (key, start + take, length - take, max(0, silent - take))
        if left[0] <= 0 or left[1] <= 0:
            left, sequence, offset = list(caps), sequence + 1, 0

    for key, length, prompt in examples:
        start = 0
        while start < length:
            if not free:
                place()
                continue
            take = min(length - start, limits.tokens)
            silent = max(0, min(prompt, start + take) - start)
            if take - silent > limits.loss_tokens:
                take = silent + limits.loss_tokens
            slots[free.pop()] = (key, start, take, silent)
            start += take
    while slots:
        place()
    return placed


@pytest.mark.parametrize("limits", [
    Limits(tokens=100, segments=5, loss_tokens=70, spare=4, waiting=8), DOCUMENTS,
    Limits(tokens=64, segments=3, loss_tokens=64, spare=0, waiting=4),
])
def test_packer_equals_a_plain_one(limits):
    draw, got = random.Random(12), []
    examples = [(k, draw.choice([1, 3, 17, 60, 90, 400, 2500]), draw.choice([0, 2, 15, 80])) for k in range(200)]

    def emit(key, start, length, total, loss, sequence, offset, ids):
        got.append((key, start, length, sequence, offset, loss))

    packer = Packer(limits, emit)
    for key, length, prompt in examples:
        packer.add(key, np.zeros(length, dtype="<u4"), prompt)
    packer.finish()
    assert got == plain_packing(examples, limits)


def test_the_limit_on_loss_binds_for_documents(spark):
    rows = [(k, "some words of text " * (40 * (k % 30) + 3)) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    sums, loss = defaultdict(int), defaultdict(int)
    for p in pack_texts(docs, PATH, DOCUMENTS).collect():
        sums[p.sequence_id] += p.length
        loss[p.sequence_id] += p.loss_tokens
    assert max(loss.values()) == 2016
    assert sum(sums.values()) > 0.96 * 2048 * len(sums)


def test_little_padding():
    draw, sequences = random.Random(3), defaultdict(int)

    def emit(key, start, length, total, loss, sequence, offset, ids):
        sequences[sequence] += length

    packer = Packer(Limits(), emit)
    for k in range(3000):
        packer.add(k, np.zeros(draw.choice([5, 80, 700, 900, 1500, 3000]), dtype="<u4"))
    packer.finish()
    assert sum(sequences.values()) > 0.98 * 2048 * len(sequences)


def test_digest_of_a_piece_is_that_of_its_ids(spark, docs):
    row = pack_texts(docs, PATH).withColumn("crc", F.crc32("ids")).first()
    assert row.crc == zlib.crc32(row.ids)


def test_packing_with_a_small_memo(spark):
    """The pipeline bounds what workers remember; ids and places of the pieces stay the same."""
    import corpus_pipeline

    assert corpus_pipeline.MEMO_CHUNKS <= 200_000
    docs = spark.createDataFrame(
        [(k, " ".join(f"w{k * 31 + j}" for j in range(200))) for k in range(30)], "doc_id bigint, text string",
    ).coalesce(1)
    assert pack_texts(docs, PATH, memo_chunks=40).collect() == pack_texts(docs, PATH).collect()
