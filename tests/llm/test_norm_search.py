"""Ranked search against a plain scorer, with buckets of all sizes."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from millrace.llm.norm_search import Bucket, Search, ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, top):
    counts = [(k, Counter(terms(t))) for k, t in docs if terms(t)]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in {(i, t) for i, t in items}:
        scored = []
        for k, c in counts:
            m = 50 + (50 * sum(c.values()) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, k is None, k or 0))
        for rank, (score, null, k) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, None if null else k, -score))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(4)
    words = [f"w{k}" for k in range(300)] + ["É", "é", "漢字", "It's", "a_b", "x\x7fy", "ÀB"]
    weights = [1 / (k + 1) for k in range(len(words))]
    docs = [(k, " ".join(draw.choices(words, weights, k=draw.choice((1, 3, 20, 200)))))
            for k in range(700)]
    docs += [(k % 5, docs[3][1]) for k in range(200)] + [(None, docs[9][1])] * 20
    docs += [(900, None), (901, ""), (902, " .,"), (903, "w0 " * 100_000), (904, "W1,w1;É")]
    items = [(k, " ".join(draw.choices(words, k=draw.randint(1, 12)))) for k in range(25)]
    items += [(1, items[1][1]), (2, "another w5"), (30, None), (31, "..."), (32, "unknown"),
              (None, "w7 w8"), (33, "w0 w0 w1 É"), (34, "w299 " * 50)]
    return docs, items


@pytest.mark.parametrize("search", [
    Search(), Search(top=3, block_terms=10, bucket=40, spread=0.99, first=0.2),
    Search(top=1, bucket=1, focus=50, first=1.0), Search(top=7, focus=0),
])
def test_against_the_plain_scorer(spark, corpus, search):
    docs, items = corpus
    left = spark.createDataFrame([(k, t, 1.0) for k, t in docs], "doc_id bigint, text string, score double")
    right = spark.createDataFrame([(k, t, 2) for k, t in items], "item_id bigint, text string, rank int")
    got = ranked_search(left.repartition(6), right, search)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items, search.top)


def test_empty_tables(spark, corpus):
    docs = spark.createDataFrame(corpus[0], "doc_id bigint, text string")
    items = spark.createDataFrame(corpus[1], "item_id bigint, text string")
    assert ranked_search(docs.limit(0), items).count() == 0
    assert ranked_search(docs, items.limit(0)).count() == 0
    assert ranked_search(docs.filter("text = ''"), items).count() == 0


def test_bounds_pass_over_buckets_and_vectors():
    """Cauchy-Schwarz prunes a whole bucket, coordinate bounds prune vectors, and no hit is lost."""
    draw = np.random.default_rng(8)
    n, width = 400, 12
    dense = (draw.random((n, width)) < 0.4) * draw.integers(1, 1000, (n, width))
    dense[dense.sum(axis=1) == 0, 0] = 1
    lengths = np.sqrt((dense.astype(float) ** 2).sum(axis=1))
    owner, term = np.nonzero(dense)
    bucket = Bucket(np.arange(n), lengths, term.astype(np.int32), dense[owner, term], (dense > 0).sum(axis=1))
    wanted = np.arange(0, width, 2)
    weights = np.array([9000, 4000, 2000, 800, 500, 300])
    scores = dense[:, wanted] @ weights
    looked = []
    for least in sorted([0, 1, *scores.tolist(), int(scores.max()) + 1]):
        at, got = bucket.search(wanted, weights, least, focus=3)
        assert at.tolist() == np.flatnonzero(scores >= max(1, least)).tolist()
        assert got.tolist() == scores[at].tolist()
        looked.append(len(at))
    too_much = int(np.sqrt((weights ** 2.0).sum()) * lengths.max() * 1.01)
    assert len(bucket.search(wanted, weights, too_much, 3)[0]) == 0
