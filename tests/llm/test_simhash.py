"""SimHash near-duplicates against brute force, with sparse and dense postings."""

import random

import pytest
import xxhash

from millrace.llm.simhash import (
    fingerprint, fingerprint_links, index, keep_one_of_each, meetings, simhash_components,
)
from millrace.operators.components import component_roots

SCHEMA = "doc_id bigint, text string, fp string, component_id int, posting int"


def plain(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def groups(fps, bits=3):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= bits:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


def test_fingerprint_equals_its_definition():
    draw = random.Random(5)
    texts = [None, "", " \n", "One", "one TWO", "Ünï cödé words É", "a b c", "a b c a b c a b c"]
    texts += [" ".join(draw.choices("ab cd Ef gh\tij\vkl 漢".split(" "), k=40)) for _ in range(20)]
    for text in texts:
        assert fingerprint(text) == plain(text)
    long = "".join(draw.choices("abcdef", k=6)) + " " + "word next " * 150_000 + "end"
    assert fingerprint(long) == plain(long)


def near_values(seed, n, flips):
    draw, values = random.Random(seed), []
    for _ in range(n):
        if values and draw.random() < 0.7:
            value = draw.choice(values)
            for bit in draw.sample(range(64), draw.randint(1, flips)):
                value ^= 1 << bit
        else:
            value = draw.getrandbits(64)
        values.append(value)
    return sorted(set(values))


def dense_values(seed, n):
    """Values that agree in five bytes, so that one posting holds them all."""
    draw, base = random.Random(seed), random.Random(seed).getrandbits(64) & ~0xFFFFFF
    return sorted({base | draw.getrandbits(24) & draw.getrandbits(24) for _ in range(n)})


@pytest.mark.parametrize("values, dense, bits", [
    (near_values(1, 300, 4), 256, 3), (near_values(2, 150, 4), 1, 3), (dense_values(3, 200), 20, 3),
    *[(sorted({1, 2, 4, 8, *near_values(5, 120, 3)}), dense, bits)
      for bits in (0, 1, 2, 3) for dense in (1, 256)],
])
def test_links_connect_what_brute_force_connects(spark, values, dense, bits):
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    links = fingerprint_links(fps, bits, dense)
    for a, b in links.distinct().collect():
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= bits
    roots = {row.a: row.b for row in component_roots(links).collect()}
    want = groups(values, bits)
    named = {}
    for value, label in zip(signed, want):
        named.setdefault(label, set()).add(roots.get(value, value))
    assert all(len(found) == 1 for found in named.values())
    assert len({next(iter(f)) for f in named.values()}) == len(named)
    assert len(named) < len(values) or not bits


def test_the_count_filter_rejects_pairs_that_meet_too_seldom(spark):
    draw = random.Random(6)
    base = draw.getrandbits(64)
    # one differing bit in each of k positions: k = 3 shares five bytes, k = 4 shares four
    values = [base, base ^ 0x010101, base ^ 0x01010101 << 24, base ^ 0xFF00, base ^ 0x0101010101]
    fps = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp bigint")
    met = {frozenset((r.a, r.b)): r.tally for r in meetings(index(fps, 3)).collect()}
    def shared(a, b):
        return sum(((a ^ b) >> 8 * p) & 255 == 0 for p in range(8))
    from math import comb
    want = {}
    for i, a in enumerate(values):
        for b in values[:i]:
            if shared(a, b) >= 4:
                key = frozenset(v - (1 << 64) if v >> 63 else v for v in (a, b))
                want[key] = comb(shared(a, b), 4)
    assert met == want
    kept = [t for t in met.values() if t >= 5]
    assert 1 in met.values() and 0 < len(kept) < len(met)  # pairs before and after the tally
    assert fingerprint_links(fps, 3).count() < len(kept)  # eight bits within one byte fail the check


def test_nothing_exploded_is_broadcast(spark):
    """The index grows 70-fold from its fingerprints, which Spark's estimates do not see."""
    fps = spark.range(30_000).selectExpr("xxhash64(id DIV 2) & ~CAST(id % 2 AS bigint) AS fp").distinct()
    links = fingerprint_links(fps)
    for frame in (links, meetings(index(fps, 3)), component_roots(links)):
        lines = frame._jdf.queryExecution().executedPlan().toString().split("\n")
        for at, line in enumerate(lines):
            if "BroadcastExchange" in line:
                depth = len(line) - len(line.lstrip(" :+-*"))
                below = []
                for other in lines[at + 1:]:
                    if len(other) - len(other.lstrip(" :+-*")) <= depth:
                        break
                    below.append(other)
                assert not any("Generate" in other or "Exchange" in other for other in below)


def test_components_of_documents(spark):
    draw = random.Random(9)
    base = [" ".join(draw.choices([f"w{i}" for i in range(400)], k=300)) for _ in range(6)]
    texts = [None, "", " ", *base, *base[:2] * 8]
    for text in base[:3]:
        words = text.split()
        for _ in range(4):
            words[draw.randrange(300)] = "changed"
            texts.append(" ".join(words))
    ids = list(range(10, 10 + len(texts)))
    rows = [*zip(ids, texts), (None, base[5]), (11, "")]
    docs = spark.createDataFrame([(k, t, "x", 0, 0) for k, t in rows], SCHEMA).repartition(5)
    got = simhash_components(docs).collect()
    want = groups([plain(t) for t in texts])
    ours = {row.doc_id: row for row in got}
    assert len(got) == len(rows)
    for at, (k, text) in enumerate(zip(ids, texts)):
        assert ours[k].component_id == ids[want[at]]
        assert ours[k].fingerprint == f"{plain(text):016x}"
    kept = [row.doc_id for row in keep_one_of_each(docs).collect()]
    assert sorted(k for k in kept if k is not None) == sorted({ids[w] for w in want})
    assert kept.count(None) == 1
    assert keep_one_of_each(docs).columns == docs.columns


def test_rows_of_one_id_are_judged_apart(spark):
    draw = random.Random(4)
    a, b, c, d = (" ".join(draw.choices([f"w{i}" for i in range(400)], k=80)) for _ in range(4))
    rows = [(1, a), (1, b), (1, b), (2, b), (3, c), (None, c), (None, d), (None, d)] + [(7, a)] * 40
    docs = spark.createDataFrame([(k, t, "x", 0, 0) for k, t in rows], SCHEMA).repartition(4)
    got = keep_one_of_each(docs, null_ids_stay=False).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, a), (1, b), (3, c), (None, d)], key=str)
    stay = keep_one_of_each(docs).collect()
    assert len(stay) == 6 and sum(r.doc_id is None for r in stay) == 3


def test_columns_with_clashing_names_come_back(spark):
    rows = [(1, "a b c d", b"x", "f"), (2, "a b c d", b"y", None), (3, None, None, "g")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _row_key binary, key string")
    got = keep_one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(tuple(r) for r in got.collect()) == [rows[0], rows[2]]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash_components(docs).count() == 0
    assert keep_one_of_each(docs).count() == 0


def test_long_chain_of_links(spark):
    links = spark.range(0, 200).selectExpr("id AS a", "id + 1 AS b").union(
        spark.createDataFrame([(500, 501), (501, 500), (7, 7)], "a bigint, b bigint"))
    roots = {row.a: row.b for row in component_roots(links).collect()}
    assert roots == {**{k: 0 for k in range(1, 201)}, 501: 500}


def test_plan_has_no_cross_join(spark):
    plan = fingerprint_links(spark.range(100).selectExpr("xxhash64(id) AS fp"))
    assert "Cartesian" not in plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan._jdf.queryExecution().executedPlan().toString()
