"""Byte-level BPE against the library, over windows of all sizes."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from millrace.llm import byte_bpe
from millrace.llm.byte_bpe import Chunks, Coder, Vocabulary, decode_texts, encode_texts, merge, read_ranks

VOCABULARY = Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
LETTERS = "ab ctheing  \n\t.,'sltd 0123é漢\U0001f600́\x85　"


@pytest.fixture(scope="module")
def library():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=VOCABULARY.pattern, special_tokens={},
                             mergeable_ranks=read_ranks(VOCABULARY.path))


def texts():
    draw = random.Random(11)
    made = ["".join(draw.choices(LETTERS, k=draw.randint(0, 400))) for _ in range(120)]
    return made + [
        None, "", " ", "\n\n\n", "<|endoftext|>", "it's they'll we've 'd '", " " * 500, "a" * 700,
        "word " * 200 + "b" * 300 + " word" * 100, "漢" * 300, "1" * 900, "x" * 63 + "'ll" + "y" * 80,
        "a \n" * 300, "\U0001f600" * 200, " a" * 100 + " " * 130 + "b " * 100,
    ]


@pytest.mark.parametrize("size, overlap", [(16, 8), (64, 16), (50, 50), (1 << 15, 1 << 9)])
def test_against_the_library(spark, library, size, overlap):
    rows = [(None if k % 9 == 0 else k // 2, t, b"clash") for k, t in enumerate(texts())] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids binary").repartition(3)
    got = decode_texts(encode_texts(docs, VOCABULARY, Chunks(size, overlap)), VOCABULARY).collect()
    def key(row):
        return (row[0] is None, row[0], row[1], row[2])
    want = [(k, np.array(library.encode_ordinary(t or ""), dtype="<u4").tobytes(), (t or "").encode())
            for k, t, _ in rows]
    assert sorted(((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got), key=key) == sorted(want, key=key)


def test_long_pieces_merge_like_short_ones(library):
    ranks, draw = read_ranks(VOCABULARY.path), random.Random(2)
    for n in (1, 2, 5, 90, 96, 97, 98, 150, 1000, 5000):
        for letters in ("a", "ab", "thein", "=-", "́é"):
            piece = "".join(draw.choices(letters, k=n))
            assert merge(piece.encode(), ranks) == library._encode_single_piece(piece)


def test_new_pieces_are_merged_together(library, monkeypatch):
    draw = random.Random(5)
    text = " ".join("".join(draw.choices("thesaroinqzx", k=draw.randint(8, 20))) for _ in range(3000))
    alone = []
    monkeypatch.setattr(byte_bpe, "merge", lambda piece, ranks: alone.append(piece) or merge(piece, ranks))
    ids = Coder(VOCABULARY).encode(text)
    assert np.frombuffer(ids, dtype="<u4").tolist() == library.encode_ordinary(text)
    assert len(alone) < 100


def test_tables_merge_like_single_pieces():
    ranks, draw = read_ranks(VOCABULARY.path), random.Random(3)
    pieces = ["".join(draw.choices(LETTERS, k=draw.randint(0, 24))).encode() for _ in range(2500)]
    pieces += [b"a" * n for n in range(97)] + ["\u00e9".encode() * 48, bytes(range(96)), bytes(range(160, 256))]
    pieces = [piece for piece in pieces if piece not in ranks]
    got = byte_bpe.Merger(ranks).merge(pieces)
    assert [np.frombuffer(ids, dtype="<u4").tolist() for ids in got] == [merge(p, ranks) for p in pieces]


def test_tables_of_a_vocabulary_without_some_bytes():
    ranks = {b"a": 0, b"b": 1, b"xy": 2, b"ab": 7, b"xyab": 9}  # x and y have no rank; ranks leave gaps
    pieces = [b"abab", b"aabb", b"xya", b"xyabxyb", b"bxyxyab", b"axyb"]
    got = byte_bpe.Merger(ranks).merge(pieces)
    assert [np.frombuffer(ids, dtype="<u4").tolist() for ids in got] == [merge(p, ranks) for p in pieces]
    with pytest.raises(KeyError):
        byte_bpe.Merger(ranks).merge([b"ab", b"ax"])
    with pytest.raises(KeyError):
        merge(b"ax", ranks)


def test_texts_encoded_together_are_told_apart(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "_GROUP_CHARS", 300)
    some = [t or "" for t in texts()] + ["", "z" * 299, "y" * 300, "x" * 301, "", "w " * 151]
    own = Coder(VOCABULARY, memo_pieces=40)
    assert [np.frombuffer(ids, dtype="<u4").tolist() for ids in own.encode_each(some)] == [
        library.encode_ordinary(t) for t in some]
    assert own.encode_each([]) == [] and all(len(p) <= 96 for p in own.memo)


def test_long_texts_take_bounded_steps(library):
    own = Coder(VOCABULARY, memo_pieces=50)
    text = "some words and 123 numbers, " * 20_000 + "z" * 100_000
    ids = own.encode(text)
    assert np.frombuffer(ids, dtype="<u4").tolist() == library.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


def test_empty_table_and_bad_windows(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert encode_texts(docs, VOCABULARY).count() == 0
    with pytest.raises(ValueError):
        encode_texts(docs, VOCABULARY, Chunks(100, 4))


def test_query_over_its_whole_table(spark, library):
    import pyarrow.parquet as pq

    from millrace.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    want = set()
    for row in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist():
        ids = library.encode_ordinary(row["text"] or "")
        want.add((row["doc_id"], len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                  hashlib.sha256((row["text"] or "").encode()).hexdigest()))
    got = QUERIES["op12_byte_bpe"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {tuple(r) for r in got.collect()} == want
